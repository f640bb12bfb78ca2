"""Checked queries for models, evaluation, clustering, recommendation, tuning
and transfer learning (M, R, E, U, C, T, D).

Where SQL can reproduce the numbers (naive Bayes tables, least squares,
exact AUC, Lloyd steps from given centres) the oracle is exact after
rounding.  Randomised fits are checked by invariants computed from the data
row by row (counts of rows meeting the model's contract), never by a bare
constant.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import RFormula, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import clustering as U
from quarry.operators import evaluation as E
from quarry.operators import features as FE
from quarry.operators import models as M
from quarry.operators import recommend as C
from quarry.operators import shaping as P
from quarry.operators import text as TX
from quarry.operators import transfer as D
from quarry.operators import tuning as T
from quarry.plans import testdata as td
from quarry.plans.registry import register
from quarry.plans.sqlparts import RATINGS, with_


def _r4(c):
    return F.round(c, 4) + F.lit(0.0)


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LABEL_R = "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE)"
FLAG_CODE = "CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS DOUBLE)"


def _lines(spark, sf, cols=LINE_FEATURES, label=LABEL_R):
    df = td.table(spark, sf, "lineitem", spread_out=True).withColumn("label", F.expr(label))
    return FE.assemble(df, cols, "features")


LABEL_COUNTS_SQL = f"""SELECT label, count(*)::BIGINT AS n, count(*)::BIGINT AS n_valid
FROM (SELECT {LABEL_R} AS label FROM lineitem) GROUP BY label"""


# ------------------------------------------------------------------ classification


@register(
    "m1_logistic_regression",
    f"""SELECT label, count(*)::BIGINT AS n, count(*)::BIGINT AS n_valid, CAST(0.0 AS DOUBLE) AS balance
FROM (SELECT {LABEL_R} AS label FROM lineitem) GROUP BY label""",
)
def m1_logistic_regression(spark, sf):
    """Unregularised fit: the intercept's score equation gives mean(p - y) = 0."""
    df = _lines(spark, sf)
    model = M.logistic_regression(df)
    scored = model.transform(df).withColumn(
        "__resid", F.element_at(vector_to_array("probability"), 2) - F.col("label")
    )
    # one scoring pass: per-label counts and residual sums; the global mean
    # residual comes from the (two-row) aggregate
    inv = M.scored_invariants(scored, "label", 2, extra=[F.sum("__resid").alias("__r")])
    everything = Window.partitionBy()
    balance = F.sum("__r").over(everything) / F.sum("n").over(everything)
    return inv.select("label", "n", "n_valid", (F.round(balance, 3) + 0.0).alias("balance"))


def _area(points):
    """Area under (fpr, tpr): trapezoids, each from the point before it in place of a sort of the whole curve."""
    from quarry.operators.shaping import lead_within

    start = points.sparkSession.createDataFrame([(0.0, 0.0)], "fpr double, tpr double")
    one = points.unionByName(start).withColumn("curve", F.lit(0)).withColumn("at", F.struct("fpr", "tpr"))
    steps = lead_within(one, ["curve"], ["fpr", "tpr"], "at", "next").where(F.col("next").isNotNull())
    return steps.agg(F.sum((F.col("next.fpr") - F.col("fpr")) * (F.col("next.tpr") + F.col("tpr")) / 2)).first()[0]


@register(
    "m1b_curve_points",
    f"""WITH c AS (SELECT l_extendedprice AS threshold, sum({LABEL_R}) AS pos, sum(1 - {LABEL_R}) AS neg FROM lineitem GROUP BY 1),
 r AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
       FROM c WINDOW w AS (ORDER BY threshold DESC))
SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / p, 4) + 0.0 AS tpr, round(fp / n, 4) + 0.0 AS fpr,
  round(tp / (tp + fp), 4) + 0.0 AS precision FROM r""",
)
def m1b_curve_points(spark, sf):
    """ROC and precision-recall points of the price as a score for returned lines, one per distinct price."""
    points = E.curve_points(_lines(spark, sf), "l_extendedprice", "label")
    return points.select("threshold", "tp", "fp", *[_r4(F.col(c)).alias(c) for c in ("tpr", "fpr", "precision")])


@register(
    "m1b_training_curves",
    f"""SELECT sum(label)::BIGINT AS n_pos, sum(1 - label)::BIGINT AS n_neg, true AS curve_ok
FROM (SELECT CAST({LABEL_R} AS INTEGER) AS label FROM lineitem)""",
)
def m1b_training_curves(spark, sf):
    df = _lines(spark, sf)
    curves = E.training_curves(M.logistic_regression(df))
    roc = curves["roc"]
    w = Window.orderBy("FPR", "TPR")
    steps = roc.select("FPR", "TPR", F.lag("TPR").over(w).alias("prev"))
    ok = steps.agg(
        F.min("FPR").alias("f0"), F.max("FPR").alias("f1"), F.min("TPR").alias("t0"), F.max("TPR").alias("t1"),
        F.bool_and(F.coalesce(F.col("TPR") >= F.col("prev"), F.lit(True))).alias("mono"),
    ).first()
    # the fit's scores, counted by curve_points, give the area that the fit states
    scored = curves["scored"].select(F.element_at(vector_to_array("probability"), 2).alias("score"), "label")
    points = E.curve_points(scored, "score", "label").select("fpr", "tpr")
    area = _area(points)
    curve_ok = bool(abs(area - curves["areaUnderROC"]) < 1e-3 and ok["f0"] == 0 and ok["t0"] == 0 and ok["f1"] == 1 and ok["t1"] == 1 and ok["mono"]
                    and 0.0 <= curves["areaUnderROC"] <= 1.0)
    return df.agg(
        F.sum(F.col("label").cast("long")).alias("n_pos"), F.sum((1 - F.col("label")).cast("long")).alias("n_neg")
    ).withColumn("curve_ok", F.lit(curve_ok))


@register("m2_decision_tree_classifier", LABEL_COUNTS_SQL)
def m2_decision_tree_classifier(spark, sf):
    df = _lines(spark, sf)
    return M.scored_invariants(M.decision_tree_classifier(df).transform(df), "label", 2)


@register("m3_random_forest_classifier", LABEL_COUNTS_SQL)
def m3_random_forest_classifier(spark, sf):
    df = _lines(spark, sf)
    return M.scored_invariants(M.random_forest_classifier(df).transform(df), "label", 2)


@register("m4_gbt_classifier", LABEL_COUNTS_SQL)
def m4_gbt_classifier(spark, sf):
    df = _lines(spark, sf)
    return M.scored_invariants(M.gbt_classifier(df).transform(df), "label", 2)


NB_BASE = f"""b AS (SELECT {FLAG_CODE} AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem),
 c AS (SELECT label, count(*) AS n, sum(f0) AS s0, sum(f1) AS s1, sum(f2) AS s2 FROM b GROUP BY label),
 t AS (SELECT count(*) AS m, count(DISTINCT label) AS k FROM b),
 prm AS (SELECT c.label, ln(n + 1.0) - ln(t.m + t.k * 1.0) AS pi,
   ln(s0 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS th0, ln(s1 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS th1,
   ln(s2 + 1.0) - ln(s0 + s1 + s2 + 3.0) AS th2 FROM c, t)"""


@register(
    "m5_naive_bayes",
    with_(NB_BASE)
    + """SELECT 'pi' AS kind, label, -1 AS feature, round(pi, 4) + 0.0 AS value FROM prm
UNION ALL SELECT 'theta', label, 0, round(th0, 4) + 0.0 FROM prm
UNION ALL SELECT 'theta', label, 1, round(th1, 4) + 0.0 FROM prm
UNION ALL SELECT 'theta', label, 2, round(th2, 4) + 0.0 FROM prm""",
)
def m5_naive_bayes(spark, sf):
    df = _lines(spark, sf, ["l_quantity", "l_discount", "l_tax"], FLAG_CODE)
    params = M.naive_bayes_params(spark, M.naive_bayes(df))
    return params.select("kind", "label", "feature", _r4(F.col("value")).alias("value"))


@register(
    "e2_multiclass_accuracy",
    with_(NB_BASE)
    + """, sc AS (SELECT b.label,
   (SELECT pi + f0 * th0 + f1 * th1 + f2 * th2 FROM prm WHERE prm.label = 0.0) AS s0,
   (SELECT pi + f0 * th0 + f1 * th1 + f2 * th2 FROM prm WHERE prm.label = 1.0) AS s1,
   (SELECT pi + f0 * th0 + f1 * th1 + f2 * th2 FROM prm WHERE prm.label = 2.0) AS s2 FROM b),
 pr AS (SELECT label, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0.0 WHEN s1 >= s2 THEN 1.0 ELSE 2.0 END AS prediction FROM sc)
SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 4) + 0.0 AS accuracy, count(*)::BIGINT AS n
FROM pr""",
)
def e2_multiclass_accuracy(spark, sf):
    df = _lines(spark, sf, ["l_quantity", "l_discount", "l_tax"], FLAG_CODE)
    scored = M.naive_bayes(df).transform(df)
    return E.multiclass_accuracy(scored).select(_r4(F.col("accuracy")).alias("accuracy"), "n")


# ------------------------------------------------------------------ evaluation


@register(
    "e1_binary_metrics",
    f"""WITH b AS (SELECT l_discount AS s, CAST({LABEL_R} AS INTEGER) AS y FROM lineitem),
 g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY s),
 r AS (SELECT pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM g),
 t AS (SELECT CAST(sum(pos) AS DOUBLE) AS np, CAST(sum(neg) AS DOUBLE) AS nn FROM g),
 pts AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tp - pos AS DOUBLE) AS tp0,
   CAST(fp - neg AS DOUBLE) AS fp0 FROM r)
SELECT round(sum((fp - fp0) / nn * (tp + tp0) / (2.0 * np)), 4) + 0.0 AS areaUnderROC,
  round(sum((tp - tp0) / np * (tp / (tp + fp)
    + CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE tp / (tp + fp) END) / 2.0), 4) + 0.0 AS areaUnderPR
FROM pts, t""",
)
def e1_binary_metrics(spark, sf):
    df = td.table(spark, sf, "lineitem").select(
        F.col("l_discount").alias("score"), F.expr(LABEL_R).alias("label")
    )
    m = E.binary_metrics(df, "score", "label")
    return m.select(_r4(F.col("areaUnderROC")).alias("areaUnderROC"), _r4(F.col("areaUnderPR")).alias("areaUnderPR"))


OLS_BASE = """d AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
 co AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM d),
 pr AS (SELECT y, a + b * x AS p FROM d, co),
 mu AS (SELECT avg(y) AS my FROM d)"""


def _ols(spark, sf):
    df = FE.assemble(td.table(spark, sf, "lineitem", spread_out=True).withColumnRenamed("l_extendedprice", "label"),
                     ["l_quantity"], "features")
    model = M.linear_regression(df, reg=0.0, elastic_net=0.0, max_iter=100, solver="normal")
    return df, model


@register(
    "r1_linear_regression",
    with_(OLS_BASE)
    + "SELECT 'intercept' AS term, round(a, 4) + 0.0 AS value FROM co UNION ALL SELECT 'coef_0', round(b, 4) + 0.0 FROM co",
)
def r1_linear_regression(spark, sf):
    _, model = _ols(spark, sf)
    return M.coefficient_table(spark, model).select("term", _r4(F.col("value")).alias("value"))


@register(
    "r1b_regression_summary",
    with_(OLS_BASE)
    + """SELECT round(sqrt(avg((y - p) * (y - p))), 4) + 0.0 AS rmse,
  round(1 - sum((y - p) * (y - p)) / sum((y - my) * (y - my)), 4) + 0.0 AS r2, count(*)::BIGINT AS n
FROM pr, mu""",
)
def r1b_regression_summary(spark, sf):
    _, model = _ols(spark, sf)
    s = E.regression_summary(model)
    res = s["residuals"].agg(F.count(F.lit(1)).alias("n"))
    return res.select(
        (F.round(F.lit(s["rootMeanSquaredError"]), 4) + 0.0).alias("rmse"),
        (F.round(F.lit(s["r2"]), 4) + 0.0).alias("r2"),
        "n",
    )


@register(
    "e3_rmse",
    with_(OLS_BASE) + "SELECT round(sqrt(avg((y - p) * (y - p))), 4) + 0.0 AS rmse FROM pr",
)
def e3_rmse(spark, sf):
    df, model = _ols(spark, sf)
    return E.rmse(model.transform(df)).select(_r4(F.col("rmse")).alias("rmse"))


@register(
    "e4_regression_metrics",
    with_(OLS_BASE)
    + """SELECT round(avg((y - p) * (y - p)), 4) + 0.0 AS mse, round(sqrt(avg((y - p) * (y - p))), 4) + 0.0 AS rmse,
  round(1 - sum((y - p) * (y - p)) / sum((y - my) * (y - my)), 4) + 0.0 AS r2,
  round(avg(abs(y - p)), 4) + 0.0 AS mae, round(avg((p - my) * (p - my)), 4) + 0.0 AS explained_variance,
  count(*)::BIGINT AS n
FROM pr, mu""",
)
def e4_regression_metrics(spark, sf):
    df, model = _ols(spark, sf)
    m = E.regression_metrics(model.transform(df))
    return m.select(*[_r4(F.col(c)).alias(c) for c in ("mse", "rmse", "r2", "mae", "explained_variance")], "n")


@register(
    "r2_glm",
    """WITH d AS (SELECT l_quantity AS x1, l_discount AS x2, l_extendedprice AS y FROM lineitem),
 s AS (SELECT covar_pop(x1, x1) AS s11, covar_pop(x1, x2) AS s12, covar_pop(x2, x2) AS s22,
   covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM d),
 b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
   (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM s)
SELECT 'intercept' AS term, round(my - b1 * m1 - b2 * m2, 4) + 0.0 AS value FROM b
UNION ALL SELECT 'coef_0', round(b1, 4) + 0.0 FROM b UNION ALL SELECT 'coef_1', round(b2, 4) + 0.0 FROM b""",
)
def r2_glm(spark, sf):
    df = FE.assemble(td.table(spark, sf, "lineitem").withColumnRenamed("l_extendedprice", "label"),
                     ["l_quantity", "l_discount"], "features")
    model = M.glm(df, reg=0.0, max_iter=25)
    return M.coefficient_table(spark, model).select("term", _r4(F.col("value")).alias("value"))


def _reg_lines(spark, sf):
    df = td.table(spark, sf, "lineitem", spread_out=True).withColumnRenamed("l_extendedprice", "label")
    return FE.assemble(df, ["l_quantity", "l_discount", "l_tax"], "features")


@register("r3_decision_tree_regressor", "SELECT count(*)::BIGINT AS n, CAST(0.0 AS DOUBLE) AS balance FROM lineitem")
def r3_decision_tree_regressor(spark, sf):
    """Leaves predict the mean of their rows, so predictions and labels have equal sums."""
    df = _reg_lines(spark, sf)
    scored = M.decision_tree_regressor(df).transform(df)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        (F.round((F.avg("prediction") - F.avg("label")) / F.avg("label"), 6) + 0.0).alias("balance"),
    )


@register("r4_random_forest_regressor", "SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS n_in_range FROM lineitem")
def r4_random_forest_regressor(spark, sf):
    df = _reg_lines(spark, sf)
    scored = M.random_forest_regressor(df).transform(df)
    bounds = df.agg(F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    ok = (F.col("prediction") >= bounds["lo"] - 1e-6) & (F.col("prediction") <= bounds["hi"] + 1e-6)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_in_range"))


@register("r5_gbt_regressor", "SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS n_finite FROM lineitem")
def r5_gbt_regressor(spark, sf):
    df = _reg_lines(spark, sf)
    scored = M.gbt_regressor(df).transform(df)
    ok = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_finite"))


# ------------------------------------------------------------------ clustering

EMB_COUNT_3 = "SELECT count(*)::BIGINT AS n_points, count(*)::BIGINT AS {b}, count(*)::BIGINT AS {c} FROM embeddings"


@register("u1_kmeans", EMB_COUNT_3.format(b="n_nearest", c="size_total"))
def u1_kmeans(spark, sf):
    df = td.embedding_vectors(spark, sf)
    model = U.kmeans(df, k=5)
    centers = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    scored = model.transform(df).withColumn("near", U.nearest_center(vector_to_array("features"), centers))
    size_total = int(sum(model.summary.clusterSizes))
    return scored.agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if(F.col("near") == F.col("prediction")).alias("n_nearest")
    ).withColumn("size_total", F.lit(size_total).cast("bigint"))


LLOYD_ITERS = 5


def _lloyd_sql(iters: int = LLOYD_ITERS) -> str:
    ctes = [
        "pts AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings)",
        "ex AS (SELECT vec_id, label, unnest(x) AS v, unnest(generate_series(1, len(x))) AS pos FROM pts)",
        "c0 AS (SELECT cid, list(m ORDER BY pos) AS cx FROM "
        "(SELECT label AS cid, pos, avg(v) AS m FROM ex GROUP BY 1, 2) GROUP BY cid)",
    ]
    for i in range(1, iters + 1):
        ctes.append(
            f"a{i} AS (SELECT p.vec_id, arg_min(c.cid, (list_distance(p.x, c.cx), c.cid)) AS cid "
            f"FROM pts p, c{i - 1} c GROUP BY p.vec_id)"
        )
        ctes.append(
            f"n{i} AS (SELECT cid, list(m ORDER BY pos) AS cx FROM (SELECT a.cid, ex.pos, avg(ex.v) AS m "
            f"FROM ex JOIN a{i} a ON ex.vec_id = a.vec_id GROUP BY 1, 2) GROUP BY cid)"
        )
        ctes.append(
            f"c{i} AS (SELECT * FROM n{i} UNION ALL SELECT * FROM c{i - 1} WHERE cid NOT IN (SELECT cid FROM n{i}))"
        )
    ctes.append(
        f"fin AS (SELECT p.vec_id, arg_min(c.cid, (list_distance(p.x, c.cx), c.cid)) AS cid "
        f"FROM pts p, c{iters} c GROUP BY p.vec_id)"
    )
    return with_(*ctes) + "SELECT vec_id, CAST(cid AS INTEGER) AS cluster FROM fin"


@register("u1_lloyd", _lloyd_sql())
def u1_lloyd(spark, sf):
    """Lloyd steps from given centres: the per-label means of the embeddings."""
    df = td.embedding_vectors(spark, sf)
    start = (
        df.select("label", F.posexplode(vector_to_array("features")).alias("pos", "v"))
        .groupBy("label", "pos")
        .agg(F.avg("v").alias("m"))
        .groupBy(F.col("label").alias("cluster"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("pm"))
        .select("cluster", F.transform("pm", lambda s: s["m"]).alias("center"))
    )
    assigned, _ = U.lloyd(df, "features", start, max_iter=LLOYD_ITERS, keep=["vec_id"])
    return assigned.select("vec_id", F.col("cluster").cast("int").alias("cluster"))


@register("u2_bisecting_kmeans", EMB_COUNT_3.format(b="n_valid", c="size_total"))
def u2_bisecting_kmeans(spark, sf):
    df = td.embedding_vectors(spark, sf)
    model = U.bisecting_kmeans(df, k=5)
    k = len(model.clusterCenters())
    size_total = int(sum(model.summary.clusterSizes))
    scored = model.transform(df)
    ok = (F.col("prediction") >= 0) & (F.col("prediction") < k)
    return scored.agg(F.count(F.lit(1)).alias("n_points"), F.count_if(ok).alias("n_valid")).withColumn(
        "size_total", F.lit(size_total).cast("bigint")
    )


@register(
    "u3_gaussian_mixture",
    "SELECT count(*)::BIGINT AS n_points, count(*)::BIGINT AS n_prob_ok, true AS weights_ok FROM embeddings",
)
def u3_gaussian_mixture(spark, sf):
    """Mixture of 5 Gaussians over the top 8 principal components of the full
    64-dimension embeddings (full 64 x 64 covariances per component are not
    identifiable from a few hundred rows; the projection uses every dimension)."""
    emb = td.embedding_vectors(spark, sf)
    df = FE.pca(emb, "features", 8, "pcs").select("vec_id", F.col("pcs").alias("features"))
    model = U.gaussian_mixture(df, k=5, max_iter=50)
    weights_ok = abs(sum(model.weights) - 1.0) < 1e-6
    scored = model.transform(df)
    prob = vector_to_array("probability")
    total = F.aggregate(prob, F.lit(0.0), lambda a, b: a + b)
    peak = F.element_at(prob, (F.col("prediction") + 1).cast("int"))
    ok = (F.abs(total - 1.0) < 1e-6) & (peak >= F.array_max(prob) - 1e-12)
    return scored.agg(F.count(F.lit(1)).alias("n_points"), F.count_if(ok).alias("n_prob_ok")).withColumn(
        "weights_ok", F.lit(weights_ok)
    )


@register(
    "u4_lda",
    "SELECT CAST(range AS INTEGER) AS topic, 3::BIGINT AS n_terms, (SELECT count(*) FROM documents)::BIGINT AS n_docs "
    "FROM range(10)",
)
def u4_lda(spark, sf):
    docs = TX.tokenize(td.table(spark, sf, "documents", spread_out=True), "text", "tokens")
    _, counted, vocab = TX.count_vectors(docs, "tokens", "features", vocab_size=500, min_df=1, min_tf=0, binary=True)
    model = U.lda(counted, k=10, max_iter=5)
    n_docs = counted.count()
    terms = U.topic_terms(model, vocab, 3)
    return terms.groupBy(F.col("topic").cast("int").alias("topic")).agg(
        F.count(F.lit(1)).alias("n_terms")
    ).withColumn("n_docs", F.lit(n_docs).cast("bigint"))


# ------------------------------------------------------------------ recommendation

RATING_SPLIT = "(('0x' || substr(md5('3:' || CAST(userId AS VARCHAR) || '|' || CAST(movieId AS VARCHAR)), 1, 7))::BIGINT % 100)"
RATING_SETS = [
    RATINGS,
    f"tr AS (SELECT * FROM ratings WHERE {RATING_SPLIT} < 80)",
    f"te AS (SELECT * FROM ratings WHERE {RATING_SPLIT} >= 80)",
]


def _ratings_split(spark, sf):
    return _split_ratings(td.ratings(spark, sf))


def _split_ratings(r):
    key = F.concat_ws("|", F.col("userId").cast("string"), F.col("movieId").cast("string"))
    return P.split_rows(r, [0.8, 0.2], key, seed=3)


@register(
    "c1_als_fit",
    with_(*RATING_SETS)
    + """SELECT 'user' AS side, count(DISTINCT userId)::BIGINT AS n_ids, (count(DISTINCT userId) * 10)::BIGINT AS n_values
FROM tr UNION ALL SELECT 'item', count(DISTINCT movieId), count(DISTINCT movieId) * 10 FROM tr""",
)
def c1_als_fit(spark, sf):
    train, _ = _ratings_split(spark, sf)
    model = C.als_fit(train)
    parts = []
    for side in ("user", "item"):
        t = C.factor_table(model, side)
        parts.append(t.agg(F.countDistinct("id").alias("n_ids"), F.count(F.lit(1)).alias("n_values")).select(
            F.lit(side).alias("side"), "n_ids", "n_values"))
    return parts[0].unionByName(parts[1])


@register(
    "c2_als_score",
    with_(*RATING_SETS)
    + """SELECT count(*)::BIGINT AS n_scored, count(*)::BIGINT AS n_finite FROM te
WHERE userId IN (SELECT userId FROM tr) AND movieId IN (SELECT movieId FROM tr)""",
)
def c2_als_score(spark, sf):
    train, test = _ratings_split(spark, sf)
    scored = C.als_score(C.als_fit(train), test)
    ok = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return scored.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(ok).alias("n_finite"))


@register(
    "j4_factor_lookup",
    with_(*RATING_SETS)
    + """SELECT count(*)::BIGINT AS n_rows,
  count(*) FILTER (WHERE userId NOT IN (SELECT userId FROM tr) OR movieId NOT IN (SELECT movieId FROM tr))::BIGINT
    AS n_unseen
FROM te""",
)
def j4_factor_lookup(spark, sf):
    """Scoring joins each row to its user and item factors; with the 'nan'
    cold-start setting a row whose user or item was not trained gets NaN."""
    train, test = _ratings_split(spark, sf)
    model = C.als_fit(train, cold_start="nan")
    scored = C.als_score(model, test)
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.isnan("prediction")).alias("n_unseen"))


def _recs_check(recs, subset, key, other):
    """Per row of ``key``: how many it got, whether they fall in rating, and, for the ids that 50 divides, whether the
    ratings are those of MLlib's own scoring of every pair."""
    recs = recs.select(key, "rating", "rank")
    plain = subset.select(key, F.posexplode("recommendations").alias("at", "r")).select(
        key, (F.col("at") + 1).alias("rank"), F.col("r.rating").alias("expected"))
    w = Window.partitionBy(key).orderBy("rank")
    steps = recs.join(plain, [key, "rank"], "full").withColumn("prev", F.lag("rating").over(w))
    close = F.abs(F.col("rating") - F.col("expected")) <= 1e-4 * (1 + F.abs("expected"))
    exact = F.when(F.col(key) % 50 != 0, F.lit(True)).otherwise(F.coalesce(close, F.lit(False)))
    return steps.groupBy(key).agg(
        F.count("rating").alias("n_recs"),
        F.bool_and(F.coalesce(F.col("rating") <= F.col("prev"), F.lit(True))).alias("ordered"),
        F.bool_and(exact).alias("exact"),
    )


def _every_50th(ids, key):
    return ids.select(F.col("id").alias(key)).where(F.col(key) % 50 == 0)


@register(
    "c3_recommend_for_users",
    with_(*RATING_SETS)
    + "SELECT DISTINCT userId, least(10, (SELECT count(DISTINCT movieId) FROM tr))::BIGINT AS n_recs, true AS ordered, "
    "true AS exact FROM tr",
)
def c3_recommend_for_users(spark, sf):
    train, _ = _ratings_split(spark, sf)
    model = C.als_fit(train)
    plain = model.recommendForUserSubset(_every_50th(model.userFactors, "userId"), 10)
    return _recs_check(C.recommend_for_users(model, 10), plain, "userId", "movieId")


@register(
    "c4_recommend_for_items",
    with_(*RATING_SETS)
    + "SELECT DISTINCT movieId, least(10, (SELECT count(DISTINCT userId) FROM tr))::BIGINT AS n_recs, true AS ordered, "
    "true AS exact FROM tr",
)
def c4_recommend_for_items(spark, sf):
    train, _ = _ratings_split(spark, sf)
    model = C.als_fit(train)
    plain = model.recommendForItemSubset(_every_50th(model.itemFactors, "movieId"), 10)
    return _recs_check(C.recommend_for_items(model, 10), plain, "movieId", "userId")


@register(
    "c3_top_products",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
 scored AS (SELECT q.vec_id, v.vec_id AS other, list_dot_product(q.e, v.e) AS s FROM v q JOIN v ON q.vec_id % 50 = 0),
 placed AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, other) AS place FROM scored)
SELECT vec_id, other, place::INTEGER AS place, round(s, 4) + 0.0 AS score FROM placed WHERE place <= 10""",
)
def c3_top_products(spark, sf):
    """The ten vectors of largest inner product for every vector whose id 50 divides, against all vectors."""
    rows = td.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    best = C.top_products(rows.where(F.col("id") % 50 == 0), rows, 10)
    return best.select(F.col("id").alias("vec_id"), "other", "place", _r4(F.col("score")).alias("score"))


@register(
    "o5_topic_terms",
    "SELECT CAST(t.range AS INTEGER) AS topic, CAST(r.range AS INTEGER) AS rank, true AS in_order "
    "FROM range(10) t, range(3) r",
)
def o5_topic_terms(spark, sf):
    """Top 3 terms per LDA topic, joined back to the vocabulary; weights
    must not increase with rank."""
    docs = TX.tokenize(td.table(spark, sf, "documents", spread_out=True), "text", "tokens")
    _, counted, vocab = TX.count_vectors(docs, "tokens", "features", vocab_size=500, min_df=1, min_tf=0, binary=True)
    terms = U.topic_terms(U.lda(counted, k=10, max_iter=5), vocab, 3)
    w = Window.partitionBy("topic").orderBy("rank")
    return terms.select(
        F.col("topic").cast("int").alias("topic"),
        F.col("rank").cast("int").alias("rank"),
        F.coalesce(F.col("weight") <= F.lag("weight").over(w), F.lit(True)).alias("in_order"),
    )


# ------------------------------------------------------------------ pipelines and tuning


@register(
    "t1_pipeline",
    """WITH lv AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS idx
  FROM orders GROUP BY o_orderpriority)
SELECT CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS label, count(*)::BIGINT AS n,
  count(*)::BIGINT AS n_valid, CAST(sum(idx) AS DOUBLE) AS sum_prio_idx
FROM orders JOIN lv USING (o_orderpriority) GROUP BY 1""",
)
def t1_pipeline(spark, sf):
    """Indexer -> assembler -> logistic regression fitted as one pipeline.
    The indexer stage is checked exactly (sum of its output per label), the
    fitted head by the scored-row invariants."""
    orders = td.table(spark, sf, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    pipe = T.pipeline([
        StringIndexer(inputCol="o_orderpriority", outputCol="prio_idx"),
        VectorAssembler(inputCols=["prio_idx", "o_totalprice"], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label"),
    ])
    scored = pipe.fit(orders).transform(orders)
    inv = M.scored_invariants(scored, "label", 2)
    idx = scored.groupBy("label").agg(F.sum("prio_idx").alias("sum_prio_idx"))
    return inv.join(idx, "label")


def _formula_frame(spark, sf):
    return td.table(spark, sf, "orders", spread_out=True).select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "good").otherwise("bad").alias("lab"),
        F.col("o_orderpriority").alias("color"),
        F.year("o_orderdate").alias("value1"),
        F.col("o_totalprice").alias("value2"),
    )


@register(
    "t3_train_validation_split",
    """SELECT count(*)::BIGINT AS n_test, 12::BIGINT AS n_points, true AS best_ok FROM orders
WHERE (('0x' || substr(md5('5:' || CAST(o_orderkey AS VARCHAR)), 1, 7))::BIGINT % 100) >= 70""",
)
def t3_train_validation_split(spark, sf):
    df = _formula_frame(spark, sf)
    train, test = P.split_rows(df, [0.7, 0.3], "o_orderkey", seed=5)
    rform = RFormula(formula="lab ~ . - o_orderkey")
    lr = LogisticRegression(labelCol="label", featuresCol="features")
    grid = T.param_grid([
        (rform.formula, ["lab ~ . - o_orderkey + color:value1", "lab ~ . - o_orderkey + color:value1 + color:value2"]),
        (lr.elasticNetParam, [0.0, 0.5, 1.0]),
        (lr.regParam, [0.1, 2.0]),
    ])
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", rawPredictionCol="rawPrediction",
                                              labelCol="label", numBins=0)
    model = T.train_validation_split(T.pipeline([rform, lr]), grid, evaluator, train, train_ratio=0.75)
    metrics = list(model.validationMetrics)
    best_ok = len(metrics) == len(grid) and all(0.0 <= m <= 1.0 for m in metrics)
    scored = model.transform(test)
    return scored.agg(F.count(F.lit(1)).alias("n_test")).select(
        "n_test", F.lit(len(metrics)).cast("bigint").alias("n_points"), F.lit(best_ok).alias("best_ok")
    )


FOLD_KEY = "concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR))"


@register(
    "t4_cross_validate",
    f"""WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y,
   (('0x' || substr(md5('9:' || {FOLD_KEY}), 1, 7))::BIGINT % 100) % 2 AS fold FROM lineitem),
 co AS (SELECT f.fold, (SELECT regr_intercept(y, x) FROM d WHERE d.fold <> f.fold) AS a,
   (SELECT regr_slope(y, x) FROM d WHERE d.fold <> f.fold) AS b FROM (SELECT DISTINCT fold FROM d) f),
 m AS (SELECT d.fold, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse FROM d JOIN co ON d.fold = co.fold
   GROUP BY d.fold)
SELECT 3::BIGINT AS n_models, round(avg(rmse), 4) + 0.0 AS rmse_reg0 FROM m""",
)
def t4_cross_validate(spark, sf):
    lines = td.table(spark, sf, "lineitem").withColumnRenamed("l_extendedprice", "label")
    key = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey")
    df = T.fold_column(FE.assemble(lines, ["l_quantity"], "features"), key, 2, seed=9)
    glr = GeneralizedLinearRegression(family="gaussian", link="identity", featuresCol="features", labelCol="label")
    grid = T.param_grid([(glr.regParam, [0.0, 0.5, 1.0])])
    evaluator = RegressionEvaluator(metricName="rmse", predictionCol="prediction", labelCol="label")
    model = T.cross_validate(T.pipeline([glr]), grid, evaluator, df, folds=2, fold_col="fold")
    avg = list(model.avgMetrics)
    return spark.range(1).select(
        F.lit(len(avg)).cast("bigint").alias("n_models"), (F.round(F.lit(avg[0]), 4) + 0.0).alias("rmse_reg0")
    )


# ------------------------------------------------------------------ transfer learning

STRAT = "(('0x' || substr(md5('0:' || CAST(label AS VARCHAR) || '|' || CAST(vec_id AS VARCHAR)), 1, 7))::BIGINT % 100)"


@register(
    "d1_label_and_split",
    f"SELECT vec_id, label, CASE WHEN {STRAT} < 60 THEN 0 ELSE 1 END AS split FROM embeddings",
)
def d1_label_and_split(spark, sf):
    df = td.embedding_vectors(spark, sf)
    train, test = D.label_and_split(df, "vec_id", "label")
    return train.select("vec_id", "label", F.lit(0).alias("split")).unionByName(
        test.select("vec_id", "label", F.lit(1).alias("split"))
    )


@register(
    "d2_embedding_classifier",
    f"SELECT label, count(*)::BIGINT AS n, count(*)::BIGINT AS n_valid FROM embeddings WHERE {STRAT} >= 60 GROUP BY label",
)
def d2_embedding_classifier(spark, sf):
    df = td.embedding_vectors(spark, sf)
    train, test = D.label_and_split(df, "vec_id", "label")
    model = D.embedding_classifier(train)
    return M.scored_invariants(model.transform(test), "label", 10)


@register(
    "d3_holdout_accuracy",
    f"SELECT count(*)::BIGINT AS n, true AS accuracy_ok FROM embeddings WHERE {STRAT} >= 60",
)
def d3_holdout_accuracy(spark, sf):
    df = td.embedding_vectors(spark, sf)
    train, test = D.label_and_split(df, "vec_id", "label")
    acc = D.holdout_accuracy(D.embedding_classifier(train), test)
    return acc.select("n", ((F.col("accuracy") >= 0) & (F.col("accuracy") <= 1)).alias("accuracy_ok"))
