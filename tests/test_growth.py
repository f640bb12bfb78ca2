"""Work that grows no faster than the tables: what is shipped, listed and dealt out."""

import os

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RFormula
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarry import sources as S
from quarry.operators import ordered_join as J
from quarry.operators import recommend as C
from quarry.operators import tuning as T
from quarry.plans import staging
from quarry.plans import testdata as td


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_images_in_batches_under_a_plain_folder(spark, monkeypatch):
    """A checkpoint folder without a scheme is where Spark's readers look for it, also on a cluster."""
    monkeypatch.setattr(staging, "is_local", lambda s: False, raising=False)
    rows = [(i, i % 3, [float(i) / 40] * 4) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    folders = staging.stage_embedding_images(spark, "own rows", df, side=2, batch=10)
    assert len(folders) > 1
    seen = {}
    for folder in folders:
        for r in S.read_images(spark, folder).collect():
            seen[int(os.path.basename(r.image.origin)[:-4])] = (r.label, list(r.image.data))
    assert seen == {i: (f"label_{i % 3}", [int((np.float32(i / 40) + 1.0) * 127.5)] * 4) for i in range(30)}


def test_paths_without_scheme_become_uris(spark):
    assert staging.as_uri(spark, "/tmp/a/b") == staging.as_uri(spark, "file:/tmp/a/b") == "file:///tmp/a/b"
    assert staging.as_uri(spark, "file:///tmp/a") == "file:///tmp/a"
    assert staging.as_uri(spark, "viewfs://in/a") == "viewfs://in/a"


@pytest.fixture(scope="module")
def orders_and_lines(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(o, int(rng.integers(20))) for o in range(120)], "o_orderkey long, o_custkey long").write.parquet(f"{at}/orders.parquet")
    lines = [(int(rng.integers(120)), int(rng.integers(15)), float(rng.integers(1, 51))) for _ in range(600)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{at}/lineitem.parquet")
    return at


def test_normal_equations_without_a_row_per_factor(spark, orders_and_lines):
    df = entry.queries()["c1_normal_equations"](spark, orders_and_lines)
    assert "Generate" not in plan(df)
    row = df.first()
    assert row.n == row.n_solved == 20


def test_normal_equations_find_a_wrong_fit(spark, orders_and_lines, monkeypatch):
    fit = C.als_fit
    monkeypatch.setattr(C, "als_fit", lambda ratings, reg: fit(ratings, reg=1.0))
    row = entry.queries()["c1_normal_equations"](spark, orders_and_lines).first()
    assert row.n == 20 and row.n_solved == 0


def test_factor_product_joins_a_row_per_id(spark, orders_and_lines):
    df = entry.queries()["c2_factor_product"](spark, orders_and_lines)
    above = plan(df).split("Aggregate [id")[0]  # over the ids' rows
    assert "Generate" not in above and "pos" not in above.split("Join")[-1]
    scored = entry.queries()["c2_als_score"](spark, orders_and_lines).first()
    assert df.first().n == scored.n_finite > 0


def test_searched_blocks_are_not_paired_with_copies_of_the_others(spark, monkeypatch):
    """Norms that are alike let no block be skipped; still a block of the searching side is sent once a round."""
    monkeypatch.setattr(C, "LEFT_BLOCK", 16)
    monkeypatch.setattr(C, "RIGHT_BLOCK", 8)
    rng = np.random.default_rng(3)
    unit = lambda n: [v / np.sqrt(v @ v) for v in rng.normal(size=(n, 12))]
    left, right = unit(64), unit(800)
    frame = lambda vectors: spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, features array<double>")
    sent, products = [], C._products

    def counted(pairs, blocks, k):
        sent.append(pairs.count())
        return products(pairs, blocks, k)

    monkeypatch.setattr(C, "_products", counted)
    got = sorted((r.id, r.other, r.place) for r in C.top_products(frame(left), frame(right), 3).collect())
    scores = np.array(left) @ np.array(right).T
    want = sorted((i, int(j), p) for i, row in enumerate(scores) for p, j in enumerate(np.argsort(-row, kind="stable")[:3], 1))
    assert got == want
    assert sum(sent) <= 64 // 16 * len(sent) and len(sent) <= 4


def test_products_with_ties_and_equal_ids_of_either_side(spark):
    left = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [-1.0, 0.0])], "id string, features array<double>")
    right = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "id long, features array<double>")
    got = sorted((r.id, r.other, r.score, r.place) for r in C.top_products(left, right, 2).collect())
    assert got == [("a", 0, 1.0, 1), ("a", 1, 1.0, 2), ("b", 0, 0.0, 1), ("b", 1, 0.0, 2), ("c", 0, -1.0, 1), ("c", 1, -1.0, 2)]


def test_spread_bounds_the_rows_of_a_partition(spark):
    df = td.spread(spark.range(0, 1000, 1, 1), rows=50)
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1000 and len(sizes) == 20 and max(sizes) <= 60
    few = spark.range(0, 1000, 1, 30)
    assert td.spread(few, rows=50) is few


def test_users_of_items_are_sent_once_a_round(spark, monkeypatch):
    monkeypatch.setattr(C, "LEFT_BLOCK", 4)
    monkeypatch.setattr(C, "RIGHT_BLOCK", 2)
    rng = np.random.default_rng(1)
    rows = [(u, int(i), float(rng.integers(1, 6))) for u in range(60) for i in rng.choice(20, 8, replace=False)]
    model = C.als_fit(spark.createDataFrame(rows, "userId int, movieId int, rating float"), rank=4, max_iter=2)
    sent, products = [], C._products

    def counted(pairs, blocks, k):
        sent.append(pairs.count())
        return products(pairs, blocks, k)

    monkeypatch.setattr(C, "_products", counted)
    got = {(r.movieId, r.rank): r.rating for r in C.recommend_for_items(model, 3).collect()}
    want = {(r.movieId, p): x.rating for r in model.recommendForAllItems(3).collect() for p, x in enumerate(r.recommendations, 1)}
    assert got == pytest.approx(want, abs=1e-4)
    assert max(sent) <= 5 and len(sent) <= 3


def test_grid_points_share_the_fits_of_early_stages(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [("ab"[int(x > 0)], float(x + rng.normal()), float(rng.normal())) for x in rng.normal(size=200)]
    df = spark.createDataFrame(rows, "lab string, v double, w double")
    rform, lr = RFormula(), LogisticRegression(maxIter=5)
    grid = T.param_grid([(rform.formula, ["lab ~ v", "lab ~ v + w"]), (lr.regParam, [0.0, 0.1, 1.0])])
    fits, fit = [], RFormula._fit
    monkeypatch.setattr(RFormula, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    evaluator = BinaryClassificationEvaluator(numBins=0)
    got = T.train_validation_split(T.pipeline([rform, lr]), grid, evaluator, df)
    assert len(fits) == 2 + 1  # one for each formula, and the last on all rows
    want = TrainValidationSplit(estimator=Pipeline(stages=[rform, lr]), estimatorParamMaps=grid, evaluator=evaluator,
                                trainRatio=0.75, seed=42).fit(df)
    # the split's column of random numbers does not depend on the estimator
    assert got.validationMetrics == pytest.approx(want.validationMetrics, abs=1e-9)
    assert [s.uid for s in got.bestModel.stages][0] == [s.uid for s in want.bestModel.stages][0]
    assert got.bestModel.stages[1].coefficients == want.bestModel.stages[1].coefficients


def test_grid_over_a_pipeline_of_one_stage(spark):
    df = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i)])) for i in range(40)], ["label", "features"])
    lr = LogisticRegression(maxIter=3)
    grid = T.param_grid([(lr.regParam, [0.0, 0.1])])
    assert len(T.train_validation_split(T.pipeline([lr]), grid, BinaryClassificationEvaluator(), df).validationMetrics) == 2


def test_busy_keys_are_found_without_a_shuffle_of_all_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 1000).alias("k"), F.col("id").cast("double").alias("t"))
    hot = spark.range(90).select(F.lit(5).cast("long").alias("k"), F.col("id").cast("double").alias("t"))
    borders = J.time_borders(rows.unionByName(hot), ["k"], "t", 20)
    exchanged = borders._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("Join LeftSemi" in line and "__cell" in line for line in exchanged)
    found = {r.k: len(r.borders) for r in borders.collect()}
    assert set(found) == {5} and found[5] >= 3


def test_ordered_join_where_many_keys_share_a_cell(spark, monkeypatch):
    monkeypatch.setattr(J, "CELLS", 2, raising=False)
    left = spark.createDataFrame([(i % 7, float(i)) for i in range(60)] + [(None, 1.0)], "k long, a double")
    right = spark.createDataFrame([(0 if i % 3 else i % 7, float(i)) for i in range(60)] + [(None, 9.0)], "k long, b double")
    got = sorted((r.k, r.a, r.b) for r in J.ordered_join(left, right, ["k"], "a", "b", bucket_rows=5).collect())
    want = sorted((x.k, x.a, y.b) for x in left.collect() for y in right.collect() if x.k is not None and x.k == y.k and x.a < y.b)
    assert got == want
