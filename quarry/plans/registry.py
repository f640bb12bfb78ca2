"""Registry of checked queries: one Spark callable and (when SQL can say it)
one DuckDB oracle statement per inventory row of SURVEY section 2.

Names are ``<id>_<operator>``.  Oracle statements run against views named
after the driver tables.  Floating results are rounded to 4 places on both
sides (``+ 0.0`` folds ``-0.0``), counts are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str | Callable[[], str]] = {}


def register(name: str, sql: str | Callable[[], str] | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query and its oracle (a statement, or a callable that builds
    it when asked).  Registering a name again replaces it when it comes from
    the same module (a repeated import); another module may not take it."""

    def deco(fn: QueryFn) -> QueryFn:
        old = QUERIES.get(name)
        if old is not None and old.__module__ != fn.__module__:
            raise ValueError(f"duplicate query {name}: {old.__module__} and {fn.__module__}")
        QUERIES[name] = fn
        ORACLES.pop(name, None)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def oracles() -> dict[str, str]:
    """Every oracle statement, built now where it is lazy."""
    return {name: sql() if callable(sql) else sql for name, sql in ORACLES.items()}


def load_all() -> None:
    """Import every module that registers queries."""
    from quarry.plans import (  # noqa: F401
        q_checks,
        q_features,
        q_graph,
        q_models,
        q_shaping,
        q_sources,
        q_text,
    )
