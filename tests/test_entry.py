"""Driver-contract tests: entry smoke, registry shape, and every query with an
oracle compared with it at sf0.001."""

import math
import re
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["src", "dst", "count"]
    assert df.count() > 0


def test_registry_shape():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 100
    for name in qs:
        assert name == "pipeline" or re.fullmatch(r"[a-z]+\d*b?_[a-z0-9_]+", name), name


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert _bag(sdf.columns, s_rows) == _bag(d_cols, d_rows)


def test_registry_loads_without_a_session_or_spark_files(monkeypatch):
    """Loading reads no file and asks no JVM, and a second load is harmless."""
    import glob
    import importlib

    from pyspark import SparkContext

    from quarry.plans import q_text, registry

    monkeypatch.setattr(glob, "glob", lambda *a, **k: [])
    monkeypatch.setattr(SparkContext, "_gateway", None)
    before = set(entry.queries())
    importlib.reload(q_text)
    assert set(entry.queries()) == before
    assert set(registry.oracles()) <= before


def test_register_refuses_a_name_of_another_module():
    from quarry.plans.registry import register

    with pytest.raises(ValueError, match="duplicate query"):
        register("x1_tokenize")(lambda spark, sf: None)


def test_entry_without_the_optional_subpackage(monkeypatch):
    """Where the subpackage is not installed, all other queries are there."""
    every = set(entry.queries())
    for name in [m for m in sys.modules if m.split(".")[:2] == ["quarry", "llm"]]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "quarry.llm", None)
    rest = set(entry.queries())
    assert rest and rest == {n for n in every if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert set(entry.oracle_sql()) <= rest
