"""Scalar column helpers (inventory L1-L8 and the hash used by splits).

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, to: str, strict: bool = False) -> Column:
    """Cast; ``strict`` raises on bad input (ANSI), otherwise gives null."""
    return _col(c).cast(to) if strict else _col(c).try_cast(to)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``double(num) / double(den)``; null instead of an error on a zero denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def split_regex(c: ColumnOrName, separator: str, literal: bool = True) -> Column:
    """Split a string on a separator; a literal separator is regex-quoted."""
    pattern = re.escape(separator) if literal else separator
    return F.split(_col(c), pattern)


def array_element(arr: ColumnOrName, index: int) -> Column:
    """0-based element, null when out of range (``get`` never raises)."""
    return F.get(_col(arr), index)


def parse_timestamp(c: ColumnOrName, fmt: str = "M/d/yyyy H:mm") -> Column:
    """Lenient timestamp parse: null instead of an error on malformed text.

    The result is TIMESTAMP_NTZ holding the wall-clock time written in the
    text, so it does not depend on the session time zone."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def epoch_seconds(c: ColumnOrName) -> Column:
    """Seconds since the epoch.  TIMESTAMP_NTZ counts its wall-clock time as
    UTC (no session time-zone shift); TIMESTAMP is an instant already."""
    return F.unix_timestamp(_col(c))


def whitespace_tokens(c: ColumnOrName) -> Column:
    """Lower-case and split on each whitespace character with SQL ``split``
    semantics: every empty piece is kept, trailing ones included.  The
    ``Tokenizer`` operator (``operators.text.tokenize``) drops trailing ones."""
    return F.split(F.lower(_col(c)), r"\s")


def hash_number(key: ColumnOrName, seed: int = 0, digit: int = 1) -> Column:
    """Deterministic number of 28 bits from the key: 7 hex digits of
    ``md5(seed || ':' || key)`` from ``digit`` on.  The value depends only on
    the key, so a split built on it survives repartitioning and executor loss,
    and SQL engines can recompute it.
    """
    text = F.concat(F.lit(f"{seed}:"), _col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), digit, 7), 16, 10).cast("bigint")


def hash_percent(key: ColumnOrName, seed: int = 0) -> Column:
    """Deterministic bucket 0..99: ``hash_number`` modulo 100."""
    return (hash_number(key, seed) % 100).cast("int")


def hash_share(key: ColumnOrName, seed: int = 0) -> Column:
    """Deterministic percentage in [0, 100): ``hash_percent`` and, from the
    next 7 digits, a fraction in steps of 2**-28."""
    return hash_percent(key, seed) + hash_number(key, seed, 8) / float(1 << 28)
