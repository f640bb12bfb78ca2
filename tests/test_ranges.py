"""Running sums and positions over ranges of values: odd values, order, and one exchange of the rows."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import shaping as P


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


ODD = [0.5, -3.0, 8.25, float("inf"), float("-inf"), float("nan"), None, 1e300, -0.25]


@pytest.mark.parametrize("descending", [False, True])
def test_sums_follow_sparks_order_of_odd_values(spark, descending):
    df = spark.createDataFrame([(v, i + 1, 1) for i, v in enumerate(ODD)], "v double, w long, one long")
    rows = P.sums_by_value(df, "v", {"cw": "w", "place": "one"}, descending=descending).collect()
    order = [r["v"] for r in df.orderBy(F.col("v").desc() if descending else F.col("v").asc()).collect()]
    got = [r["v"] for r in sorted(rows, key=lambda r: r["place"])]
    assert [str(v) for v in got] == [str(v) for v in order]
    want, total = {}, 0
    weight = {str(v): i + 1 for i, v in enumerate(ODD)}
    for v in order:
        total += weight[str(v)]
        want[str(v)] = total
    assert {str(r["v"]): r["cw"] for r in rows} == want


def test_sums_of_many_values_and_of_none(spark):
    df = spark.range(5000).select((F.xxhash64("id") % 1_000_003).alias("v"), F.lit(1).alias("one")).dropDuplicates(["v"])
    rows = P.sums_by_value(df, "v", {"place": "one"}).collect()
    assert [r["place"] for r in sorted(rows, key=lambda r: r["v"])] == list(range(1, len(rows) + 1))
    assert P.sums_by_value(df.where("v IS NULL"), "v", {"place": "one"}).count() == 0


def test_rows_are_exchanged_once(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("v"), F.lit(1).alias("one"))
    plan = _plan(P.sums_by_value(df, "v", {"place": "one"}))
    # one exchange for the rows, one for the totals (partial sums, one row per range)
    assert plan.count("Exchange hashpartitioning(__rid") == 2
    assert "rangepartitioning" not in plan and "__pid" not in plan


def test_index_needs_no_window_over_rows(spark):
    df = spark.createDataFrame([(i % 7, f"k{i:03d}") for i in range(500)], "a int, b string")
    placed = P.global_index(df, [F.col("a").desc(), F.col("b")], "at")
    got = [(r["a"], r["b"]) for r in sorted(placed.collect(), key=lambda r: r["at"])]
    assert got == sorted(((i % 7, f"k{i:03d}") for i in range(500)), key=lambda r: (-r[0], r[1]))
    assert sorted(r["at"] for r in placed.collect()) == list(range(500))
    assert "hashpartitioning(__pid" not in _plan(placed).split("BroadcastExchange")[0]


@pytest.mark.parametrize("kind", ["long", "double", "decimal(12,3)", "date", "string"])
def test_quantiles_of_every_kind_of_column(spark, kind):
    numbers = [(i * 37) % 101 for i in range(240)] + [5] * 120 + [None] * 9
    base = spark.createDataFrame([(n,) for n in numbers], "n int")
    value = F.date_add(F.lit("2020-01-01").cast("date"), F.col("n")) if kind == "date" else F.col("n").cast(kind)
    df = base.select(value.alias("v"))
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    kept = sorted(r["v"] for r in df.where("v IS NOT NULL").collect())
    want = {p: kept[max(1, math.ceil(p * len(kept) - 1e-12)) - 1] for p in probs}
    assert {r["p"]: r["value"] for r in P.exact_quantiles(df, "v", probs).collect()} == want
    none = P.exact_quantiles(df.where("v IS NULL"), "v", probs).collect()
    assert [r["value"] for r in none] == [None] * len(probs)
