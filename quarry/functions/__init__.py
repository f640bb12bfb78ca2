"""Column-expression helpers; all are JVM-side built-ins (no Python UDFs)."""

from quarry.functions.scalar import (
    array_element,
    epoch_seconds,
    hash_number,
    hash_percent,
    hash_share,
    parse_timestamp,
    ratio,
    safe_cast,
    split_regex,
    whitespace_tokens,
)

__all__ = [
    "array_element",
    "epoch_seconds",
    "hash_number",
    "hash_percent",
    "hash_share",
    "parse_timestamp",
    "ratio",
    "safe_cast",
    "split_regex",
    "whitespace_tokens",
]
