"""Ordered joins, dictionary encoding, sparse contingency, approximate quantiles and curve points."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.operators import evaluation as E
from quarry.operators import features as FE
from quarry.operators import ordered_join as O
from quarry.operators import shaping as P

# ------------------------------------------------------------------ ordered join


def trips(seed, n=250):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["hot", "hot", "b", "c", None]), rnd.choice([None, rnd.randint(0, 60), rnd.randint(0, 60)]), i) for i in range(n)]
    return rows + [rows[0], rows[0]]


def sides(spark, left, right):
    return (spark.createDataFrame(left, "k string, t long, l long"), spark.createDataFrame(right, "k string, u long, r long"))


@pytest.mark.parametrize("within", [None, 7])
@pytest.mark.parametrize("rows", [3, 40, 10_000])
def test_ordered_join(spark, within, rows):
    left, right = trips(1), trips(2)
    want = Counter((a[0], a[2], b[2]) for a in left for b in right if None not in (a[0], a[1], b[1]) and a[0] == b[0]
                   and a[1] < b[1] and (within is None or b[1] <= a[1] + within))
    got = O.ordered_join(*sides(spark, left, right), ["k"], "t", "u", within, rows)
    assert Counter((r.k, r.l, r.r) for r in got.collect()) == want


def test_ordered_join_edges(spark):
    left, right = sides(spark, trips(1), trips(2))
    assert O.ordered_join(left.limit(0), right, ["k"], "t", "u", None, 5).collect() == []
    assert O.ordered_join(left, right.limit(0), ["k"], "t", "u", None, 5).collect() == []
    with pytest.raises(ValueError):
        O.ordered_join(left, left, ["k"], "t", "t")


def test_busy_key_is_many_tasks(spark):
    left = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    right = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("u"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = O.ordered_join(left, right, ["k"], "t", "u", within=100, bucket_rows=100)
        tasks = pairs.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) >= 6 and sum(r["count"] for r in tasks) == sum(min(100, 2999 - t) for t in range(3000))
    assert max(r["count"] for r in tasks) < 0.4 * sum(r["count"] for r in tasks)
    # out of order pairs never meet: a left row is repeated for its own and the next bucket or two only
    sizes = O.time_borders(right, ["k"], "u", 100).select(F.size("borders")).first()[0]
    assert 25 <= sizes <= 35


# ------------------------------------------------------------------ dictionary


def values(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 31 == 0 else f"v{i % 50}") for i in range(600)]
    return spark.createDataFrame(rows, "id int, v string").repartition(5)


def test_dictionary_equals_the_indexer(spark):
    df = values(spark).where("v IS NOT NULL")
    _, want = FE.index_strings(df, "v", "ix")
    for share in (0.001, 0.1, 1.0):
        got = FE.encode_strings(df, FE.label_dictionary(df, "v"), "v", "ix", hot_share=share)
        assert got.columns == ["id", "v", "ix"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dictionary_invalid_values(spark):
    df = values(spark)
    known = FE.label_dictionary(df.where("v IN ('hot', 'v1', 'v2')"), "v")
    kept = FE.encode_strings(df, known, "v", "ix", "keep")
    assert kept.count() == 600 and kept.where("ix = 3").count() == df.where("v IS NULL OR v NOT IN ('hot', 'v1', 'v2')").count()
    skipped = FE.encode_strings(df, known, "v", "ix", "skip")
    assert {r.v for r in skipped.collect()} == {"hot", "v1", "v2"}
    with pytest.raises(Exception, match="no index for"):
        FE.encode_strings(df, known, "v", "ix").collect()
    with pytest.raises(ValueError):
        FE.encode_strings(df, known, "v", "ix", "other")


def test_no_labels_in_the_plan(spark):
    df = values(spark).where("v IS NOT NULL")
    got = FE.encode_strings(df, FE.label_dictionary(df, "v"), "v", "ix", hot_share=0.1)
    plan = got._jdf.queryExecution().toString()
    assert "v17" not in plan and "Join" in plan and "UDF" not in plan


# ------------------------------------------------------------------ chi-squared


def test_sparse_contingency_counts_zeros(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("xyz"), [rnd.choice([0.0, 0.0, 1.0, 2.5]) for _ in range(4)] + [0.0]) for _ in range(300)]
    want = Counter((f, v, lab) for lab, vec in rows for f, v in enumerate(vec))
    sparse = [(lab, Vectors.sparse(5, [(i, v) for i, v in enumerate(vec) if v or i == 1])) for lab, vec in rows]
    for df in (spark.createDataFrame(sparse, ["label", "f"]), spark.createDataFrame(rows, "label string, f array<double>")):
        got = FE.contingency(df, "f", "label").collect()
        assert {(r.feature, r.value, r.label): r.n for r in got} == dict(want) and len(got) == len(want)


def plain_statistic(rows, f):
    values, labels = Counter(v[f] for _, v in rows), Counter(lab for lab, _ in rows)
    seen, n = Counter((v[f], lab) for lab, v in rows), len(rows)
    total = sum((seen[a, b] - values[a] * labels[b] / n) ** 2 / (values[a] * labels[b] / n) for a in values for b in labels)
    return total, (len(values) - 1) * (len(labels) - 1)


def test_chi2_of_sparse_rows(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("xyzw"), [rnd.choice([0.0, 0.0, 0.0, 1.0, -2.0]), float(rnd.random() < 0.1), 0.0, 3.0, rnd.choice([1.0, 2.0])]) for _ in range(500)]
    rows += [("x", [5.0, 1.0, 0.0, 3.0, 1.0])] * 30
    df = spark.createDataFrame([(lab, Vectors.sparse(5, [(i, v) for i, v in enumerate(vec) if v])) for lab, vec in rows], ["label", "f"])
    got = {r.featureIndex: r for r in FE.chi2_test(df, "f", "label").collect()}
    assert set(got) == set(range(5))
    for f in range(5):
        statistic, dof = plain_statistic(rows, f)
        assert got[f].degreesOfFreedom == dof and got[f].statistic == pytest.approx(statistic, abs=1e-7)
    assert got[2].pValue == 1.0 and got[3].pValue == 1.0
    assert "Python" not in FE.chi2_test(df, "f", "label")._jdf.queryExecution().toString()


def upper_gamma(a, z):
    """Q(a, z) by its integral: Simpson's rule on a fine grid of the tail and the head, whichever is short."""
    if z <= 0:
        return 1.0
    top = max(z, a) + 60 * math.sqrt(a + 10) + 60
    t = np.linspace(z, top, 400_001)[0:]
    y = np.exp((a - 1) * np.log(t) - t - math.lgamma(a))
    h = (top - z) / 400_000
    return float(h / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()))


def test_chi2_tail(spark):
    cases = [(float(x), dof) for dof in (1, 2, 3, 7, 8, 40, 41, 500, 5001, 20_000) for x in (0.02, 0.5, 3.0, 0.8 * dof, dof - 0.5, dof + 2.5, 1.1 * dof + 3, 2 * dof + 30) if x > 0]
    df = spark.createDataFrame(cases, "x double, dof long")
    for r in df.select("x", "dof", FE.chi2_tail(F.col("x"), F.col("dof")).alias("p")).collect():
        assert r.p == pytest.approx(upper_gamma(r.dof / 2, r.x / 2), rel=2e-5, abs=2e-9), (r.x, r.dof)


# ------------------------------------------------------------------ quantiles and curves


def test_approx_quantiles_keep_their_error(spark):
    rnd = random.Random(9)
    rows = [("a", float(rnd.choice([rnd.gauss(0, 1), 3.0]))) for _ in range(5000)] + [("b", float(i)) for i in range(700)] + [("c", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = P.approx_quantiles(df, "x", probs, 0.01, ["g"]).collect()
    assert len(got) == 4 * len(probs)
    for r in got:
        own = sorted(x for g, x in rows if g == r.g and x is not None)
        assert r.n == len(own)
        if own:
            below, upto = sum(x < r.value for x in own), sum(x <= r.value for x in own)
            assert below <= r.p * r.n + 0.01 * r.n + 1 and upto >= r.p * r.n - 0.01 * r.n - 1 and upto > below
        else:
            assert r.value is None
    assert P.approx_quantiles(df.limit(0), "x", [0.5], 0.1, ["g"]).collect() == []
    with pytest.raises(ValueError):
        P.approx_quantiles(df, "x", [0.5], 0)


def test_curve_points(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([0.5, round(rnd.random(), 2)]), float(rnd.random() < 0.3)) for _ in range(400)]
    got = E.curve_points(spark.createDataFrame(rows + [(None, 1.0), (0.1, None)], "s double, y double"), "s", "y").collect()
    pos, neg = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    assert sorted(r.threshold for r in got) == sorted({s for s, _ in rows})
    for r in got:
        tp, fp = sum(y for s, y in rows if s >= r.threshold), sum(1 - y for s, y in rows if s >= r.threshold)
        assert (r.tp, r.fp) == (tp, fp) and r.tpr == pytest.approx(tp / pos) and r.fpr == pytest.approx(fp / neg)
        assert r.precision == pytest.approx(tp / (tp + fp))
    none = E.curve_points(spark.createDataFrame([(0.2, 0.0)], "s double, y double"), "s", "y").collect()
    assert [(r.tpr, r.fpr, r.precision) for r in none] == [(None, 1.0, 0.0)]
