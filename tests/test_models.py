import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quarry.operators import clustering as U
from quarry.operators import evaluation as E
from quarry.operators import models as M
from quarry.operators import recommend as C
from quarry.operators import transfer as D
from quarry.operators import tuning as T


def test_binary_metrics_match_mllib_exact(spark):
    rng = np.random.default_rng(3)
    scores = rng.integers(0, 20, 400) / 20.0  # many ties
    labels = (rng.random(400) < 0.3 + 0.5 * scores).astype(float)
    df = spark.createDataFrame([(float(s), float(y)) for s, y in zip(scores, labels)], "score double, label double")
    got = E.binary_metrics(df, "score", "label").first()
    for metric in ("areaUnderROC", "areaUnderPR"):
        ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=metric,
                                            numBins=0).evaluate(df)
        assert got[metric] == pytest.approx(ref, abs=1e-12)


def test_regression_metrics_match_mllib(spark):
    rng = np.random.default_rng(4)
    rows = [(float(p), float(p + rng.normal())) for p in rng.normal(size=200)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    got = E.regression_metrics(df).first()
    for name in ("mse", "rmse", "r2", "mae"):
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df), rel=1e-9)
    y = np.array([r[1] for r in rows])
    p = np.array([r[0] for r in rows])
    assert got.explained_variance == pytest.approx(np.mean((p - y.mean()) ** 2), rel=1e-9)
    assert E.multiclass_accuracy(df.select(F.lit(1.0).alias("prediction"), F.lit(1.0).alias("label"))).first().accuracy == 1.0


def test_naive_bayes_guards_and_params(spark):
    ok = spark.createDataFrame(
        [(0.0, Vectors.dense(1.0, 0.0)), (1.0, Vectors.dense(0.0, 2.0)), (1.0, Vectors.dense(1.0, 1.0))],
        ["label", "features"],
    )
    model = M.naive_bayes(ok)
    params = {(r.kind, r.label, r.feature): r.value for r in M.naive_bayes_params(spark, model).collect()}
    assert params[("pi", 0.0, -1)] == pytest.approx(np.log(2) - np.log(5))
    assert params[("theta", 1.0, 1)] == pytest.approx(np.log(4) - np.log(4 + 2))
    with pytest.raises(ValueError):
        M.naive_bayes(ok.where("label != 0"))
    neg = spark.createDataFrame([(0.0, Vectors.dense(-1.0)), (1.0, Vectors.dense(1.0))], ["label", "features"])
    with pytest.raises(ValueError):
        M.naive_bayes(neg)


def test_linear_models_and_summary(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=100)
    df = spark.createDataFrame([(Vectors.dense([float(a)]), float(2 * a + 1)) for a in x], ["features", "label"])
    lr = M.linear_regression(df, reg=0.0, elastic_net=0.0, solver="normal")
    coefs = {r.term: r.value for r in M.coefficient_table(spark, lr).collect()}
    assert coefs["intercept"] == pytest.approx(1.0) and coefs["coef_0"] == pytest.approx(2.0)
    s = E.regression_summary(lr)
    assert s["r2"] == pytest.approx(1.0) and s["residuals"].count() == 100
    g = M.glm(df, reg=0.0)
    assert g.coefficients[0] == pytest.approx(2.0)
    ref = LinearRegression(regParam=0.3, elasticNetParam=0.8, maxIter=10).fit(df)
    assert M.linear_regression(df).coefficients == ref.coefficients


def test_classifiers_invariants(spark):
    rng = np.random.default_rng(6)
    rows = [(Vectors.dense(rng.normal(size=2).tolist()), float(i % 2)) for i in range(120)]
    df = spark.createDataFrame(rows, ["features", "label"])
    for fit in (M.logistic_regression, M.decision_tree_classifier, M.random_forest_classifier, M.gbt_classifier):
        inv = {r.label: (r.n, r.n_valid) for r in M.scored_invariants(fit(df).transform(df), "label", 2).collect()}
        assert inv == {0.0: (60, 60), 1.0: (60, 60)}
    curves = E.training_curves(M.logistic_regression(df))
    assert 0.0 <= curves["areaUnderROC"] <= 1.0 and curves["roc"].count() >= 2


def test_lloyd_matches_numpy(spark):
    rng = np.random.default_rng(7)
    pts = np.vstack([rng.normal(0, 1, (30, 2)), rng.normal(6, 1, (30, 2))])
    df = spark.createDataFrame([(i, Vectors.dense(p.tolist())) for i, p in enumerate(pts)], ["id", "features"])
    init = np.array([[0.5, 0.5], [5.0, 5.0]])
    centers = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(init)], "cluster int, center array<double>")
    assigned, table = U.lloyd(df, "features", centers, max_iter=3, keep=["id"])
    c = init.copy()
    for _ in range(3):
        lab = np.argmin(((pts[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
        c = np.array([pts[lab == k].mean(0) for k in range(2)])
    lab = np.argmin(((pts[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
    got = {r.id: r.cluster for r in assigned.collect()}
    assert [got[i] for i in range(60)] == lab.tolist()
    assert table.count() == 4


def test_kmeans_gmm_lda(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(Vectors.dense(rng.normal(size=2).tolist()),) for _ in range(60)], ["features"])
    km = U.kmeans(df, k=3)
    assert sum(km.summary.clusterSizes) == 60
    bk = U.bisecting_kmeans(df, k=3)
    assert sum(bk.summary.clusterSizes) == 60
    assert U.cluster_centers(spark, km).groupBy("cluster").count().count() == 3
    gm = U.gaussian_mixture(df, k=2)
    assert sum(gm.weights) == pytest.approx(1.0)
    comps = U.mixture_components(gm).collect()
    assert len(comps) == 2 and sum(r.weight for r in comps) == pytest.approx(1.0)
    docs = spark.createDataFrame([(Vectors.dense([1.0, 0.0, 2.0]),), (Vectors.dense([0.0, 3.0, 1.0]),)], ["features"])
    lda = U.lda(docs, k=2, max_iter=2)
    vocab = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "index int, term string")
    terms = U.topic_terms(lda, vocab, 2)
    assert terms.count() == 4


def test_als_and_recommendations(spark):
    rows = [(u, i, float((u + i) % 5 + 1)) for u in range(12) for i in range(15) if (u * i) % 3 != 1]
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating float")
    model = C.als_fit(ratings, rank=3, max_iter=3)
    recs = C.recommend_for_users(model, 4)
    per_user = {r.userId: r["count"] for r in recs.groupBy("userId").count().collect()}
    assert set(per_user.values()) == {4} and len(per_user) == 12
    unseen = spark.createDataFrame([(99, 1, 1.0)], "userId int, movieId int, rating float")
    assert C.als_score(model, unseen).count() == 0  # cold-start rows dropped
    assert C.factor_table(model, "item").count() == 15 * 3


def test_grid_tuning_and_transfer(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import RFormula

    rf, lr = RFormula(), LogisticRegression()
    grid = T.param_grid([(rf.formula, ["a ~ b", "a ~ b + c"]), (lr.elasticNetParam, [0.0, 0.5, 1.0]),
                         (lr.regParam, [0.1, 2.0])])
    assert len(grid) == 12 and T.grid_table(spark, grid).count() == 36
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).cast("double").alias("label"))
    folds = T.fold_column(df, "id", 2)
    assert folds.select("fold").distinct().count() == 2
    assert {r.fold for r in folds.collect()} == {r.fold for r in T.fold_column(df.repartition(5), "id", 2).collect()}
    train, test = D.label_and_split(df, "id", "label")
    assert train.count() + test.count() == 100
    for c in (0.0, 1.0, 2.0):
        assert train.where(F.col("label") == c).count() > 0
