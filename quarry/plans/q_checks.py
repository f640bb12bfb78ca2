"""Second queries of operators whose first query checks only invariants, and
the settings that the worked examples use: fits with a closed form, trees of
one split, one boosting round, factor products, the fitted TF-IDF."""

from __future__ import annotations

import math
import uuid

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quarry.operators import clustering as U
from quarry.operators import features as FE
from quarry.operators import models as M
from quarry.operators import recommend as C
from quarry.operators import shaping as P
from quarry.operators import text as TX
from quarry.operators import transfer as D
from quarry.operators import tuning as T
from quarry.plans import q_models, q_text
from quarry.plans import testdata as td
from quarry.plans.q_models import LINE_FEATURES, RATING_SETS, _lines
from quarry.plans.registry import ORACLES, register
from quarry.plans.sqlparts import with_
from quarry.session import stage_path
from quarry.sources.files import write_table


def _r(c, digits):
    return F.round(c, digits) + F.lit(0.0)


def _stored_split(spark, sf):
    """The ratings' split over stored ratings, for queries that read both its sides or one of them twice."""
    path = write_table(td.ratings(spark, sf), stage_path(spark, f"ratings-{uuid.uuid4().hex}"))
    return q_models._split_ratings(spark.read.parquet(path))


# One standardised feature: the slope is the correlation, shrunk by the L1 part and scaled by the L2 part of the
# penalty (both in units of the label's deviation).
SHRUNK = """WITH d AS (SELECT l_quantity AS x, l_extendedprice / 10000 AS y FROM lineitem),
 s AS (SELECT corr(x, y) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my FROM d),
 b AS (SELECT sign(r) * greatest(abs(r) - {l1} / sy, 0) / (1 + {l2} / sy) * sy / sx AS b, mx, my FROM s)
SELECT 'intercept' AS term, round(my - b * mx, 3) + 0.0 AS value FROM b
UNION ALL SELECT 'coef_0', round(b, 3) + 0.0 FROM b"""


def _price_by_quantity(spark, sf):
    lines = td.table(spark, sf, "lineitem").withColumn("label", F.col("l_extendedprice") / 10000)
    return FE.assemble(lines, ["l_quantity"], "features")


@register("r1_elastic_net", SHRUNK.format(l1=0.3 * 0.8, l2=0.3 * 0.2))
def r1_elastic_net(spark, sf):
    """Regularisation 0.3 with elastic net 0.8, the default setting."""
    model = M.linear_regression(_price_by_quantity(spark, sf), max_iter=200, tol=1e-12)
    return M.coefficient_table(spark, model).select("term", _r(F.col("value"), 3).alias("value"))


@register("r2_ridge", SHRUNK.format(l1=0, l2=0.3))
def r2_ridge(spark, sf):
    """Gaussian GLM with ridge 0.3, the default setting."""
    model = M.glm(_price_by_quantity(spark, sf), max_iter=25)
    return M.coefficient_table(spark, model).select("term", _r(F.col("value"), 3).alias("value"))


# The best split of three features with few values: the greatest gain of {impurity} over all thresholds.
STUMP = """WITH d AS (SELECT CAST({first} AS DOUBLE) AS f0, l_discount AS f1, l_tax AS f2, {label} AS y FROM lineitem),
 lg AS (SELECT 0 AS f, f0 AS v, y FROM d UNION ALL SELECT 1, f1, y FROM d UNION ALL SELECT 2, f2, y FROM d),
 cell AS (SELECT f, v, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM lg GROUP BY f, v),
 cut AS (SELECT f, v, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q,
   sum(n) OVER (PARTITION BY f) AS tn, sum(s) OVER (PARTITION BY f) AS ts FROM cell
   WINDOW w AS (PARTITION BY f ORDER BY v ROWS UNBOUNDED PRECEDING)),
 best AS (SELECT f, v FROM cut WHERE n < tn
   ORDER BY s * s / n + (ts - s) * (ts - s) / (tn - n) DESC, f, v LIMIT 1),
 side AS (SELECT lg.v <= best.v AS lo, lg.y FROM lg JOIN best ON lg.f = best.f)
SELECT round(avg(y), 6) + 0.0 AS value, count(*)::BIGINT AS n FROM side GROUP BY lo"""

FEW = ["l_linenumber", "l_discount", "l_tax"]


LARGE = "CAST(CASE WHEN l_quantity + (l_linenumber - 4) * 5 > 25 THEN 1 ELSE 0 END AS DOUBLE)"


@register("m2_decision_stump", STUMP.format(first="l_quantity", label=LARGE))
def m2_decision_stump(spark, sf):
    """Depth 1, Gini: with two classes its gain orders splits as the variance does; a leaf's share of class 1."""
    df = _lines(spark, sf, cols=["l_quantity", *FEW[1:]], label=LARGE)
    scored = M.decision_tree_classifier(df, max_depth=1, max_bins=64).transform(df)
    share = _r(F.get(vector_to_array("probability"), F.lit(1)), 6).alias("value")
    return scored.select(share).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@register("r3_regression_stump", STUMP.format(first="l_linenumber", label="l_quantity"))
def r3_regression_stump(spark, sf):
    """Depth 1, variance: a leaf predicts the mean of its rows."""
    df = FE.assemble(td.table(spark, sf, "lineitem").withColumnRenamed("l_quantity", "label"), FEW, "features")
    scored = M.decision_tree_regressor(df, max_depth=1).transform(df)
    return scored.groupBy(_r(F.col("prediction"), 6).alias("value")).agg(F.count(F.lit(1)).alias("n"))


@register("r5_one_round", "SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS n_as_the_tree FROM lineitem")
def r5_one_round(spark, sf):
    """One round of boosting predicts what a single tree does, row by row."""
    df = FE.assemble(td.table(spark, sf, "lineitem").withColumnRenamed("l_extendedprice", "label"),
                     ["l_quantity", "l_discount"], "features")
    tree = M.decision_tree_regressor(df).transform(df).withColumnRenamed("prediction", "tree")
    both = M.gbt_regressor(df, max_iter=1).transform(tree)
    same = F.abs(F.col("prediction") - F.col("tree")) <= 1e-9 * F.abs("tree")
    varies = F.countDistinct("tree") > 1  # a constant fit counts as wrong
    return both.agg(F.count(F.lit(1)).alias("n"), F.when(varies, F.count_if(same)).otherwise(0).alias("n_as_the_tree"))


@register(
    "c2_factor_product",
    with_(*RATING_SETS)
    + """SELECT count(*)::BIGINT AS n FROM te
WHERE userId IN (SELECT userId FROM tr) AND movieId IN (SELECT movieId FROM tr)""",
)
def c2_factor_product(spark, sf):
    """Test ratings whose prediction is the product of their user's and item's factors."""
    train, test = _stored_split(spark, sf)
    model = C.als_fit(train)
    scored = C.als_score(model, test).select("userId", "movieId", "prediction")
    # one row per id with a column per place, not a row per rating and place
    at = range(model.rank)
    user, item = (
        C.factor_table(model, side).groupBy(F.col("id").alias(key)).agg(
            *[F.max(F.when(F.col("pos") == i, F.col("value"))).cast("double").alias(f"{side}{i}") for i in at])
        for side, key in (("user", "userId"), ("item", "movieId")))
    dot = sum((F.col(f"user{i}") * F.col(f"item{i}") for i in at), F.lit(0.0)).alias("dot")
    both = scored.join(user, "userId").join(item, "movieId").select("prediction", dot)
    close = F.abs(F.col("dot") - F.col("prediction")) <= 1e-3 * (1 + F.abs("dot"))
    return both.agg(F.count_if(close & (F.col("dot") != 0)).alias("n"))


@register("x6_tf_idf_fitted", lambda: ORACLES["x6_tf_idf"])
def x6_tf_idf_fitted(spark, sf):
    """The fitted IDF model over the count vectors: the same weights as the vocabulary shortcut."""
    docs = TX.tokenize(td.table(spark, sf, "documents", spread_out=True), "text", "tokens")
    _, counted, vocab = TX.count_vectors(
        docs, "tokens", "counts", vocab_size=q_text.VOCAB_SIZE, min_df=q_text.MIN_DF, min_tf=1)
    out = q_text._vector_terms(TX.tf_idf(counted, "counts", "tfidf"), vocab, "tfidf", "weight")
    return out.select("doc_id", "term", _r(F.col("weight"), 4).alias("weight"))


@register(
    "t2_param_grid",
    """WITH axis AS (SELECT row_number() OVER (ORDER BY r_regionkey) - 1 AS i, r_regionkey FROM region),
 mix AS (SELECT unnest([0, 1, 2]) AS j, unnest(['0.0', '0.5', '1.0']) AS m),
 grid AS (SELECT i * 3 + j AS point, CAST(CAST(r_regionkey AS DOUBLE) AS VARCHAR) AS reg, m FROM axis, mix)
SELECT CAST(point AS INTEGER) AS point, 'regParam' AS param, reg AS value FROM grid
UNION ALL SELECT CAST(point AS INTEGER), 'elasticNetParam', m FROM grid""",
)
def t2_param_grid(spark, sf):
    """The grid of a penalty per region (a small dimension table) and three elastic-net mixes."""
    keys = sorted(float(r[0]) for r in td.table(spark, sf, "region").select("r_regionkey").collect())
    lr = LinearRegression()
    return T.grid_table(spark, T.param_grid([(lr.regParam, keys), (lr.elasticNetParam, [0.0, 0.5, 1.0])]))


@register(
    "m1_score_equations",
    "SELECT 0 AS feature, round(sum(l_quantity * y) / sum(l_quantity), 3) + 0.0 AS value FROM d\n"
    .replace("FROM d", "FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)")
    + "UNION ALL SELECT 1, round(sum(l_tax * y) / sum(l_tax), 3) + 0.0 "
      "FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)",
)
def m1_score_equations(spark, sf):
    """Unpenalised logistic fit: weighted by a feature, mean probability and mean label agree."""
    df = _lines(spark, sf)
    scored = M.logistic_regression(df, reg=0.0, elastic_net=0.0, max_iter=200, tol=1e-10).transform(df)
    p = F.get(vector_to_array("probability"), F.lit(1))
    parts = []
    for i, col in enumerate([LINE_FEATURES[0], LINE_FEATURES[3]]):
        value = _r(F.sum(F.col(col) * p) / F.sum(col), 3)
        parts.append(scored.agg(value.alias("value")).select(F.lit(i).alias("feature"), "value"))
    return parts[0].unionByName(parts[1])


def _tree_columns(df, trees, name, column):
    """``df`` with the column ``column`` of every tree of an ensemble, as name0, name1 ..."""
    for i, tree in enumerate(trees):
        own = {c: f"__{c}" for c in ("rawPrediction", "probability", "prediction") if c in tree.transform(df.limit(0)).columns}
        scored = tree.transform(df.drop(*own))
        df = scored.withColumn(f"{name}{i}", column).drop(*own)
    return df


def _near(a, b, tolerance=1e-9):
    return F.abs(a - b) <= tolerance * (1 + F.abs(b))


MORE_THAN_MAJORITY = "SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS n_agree, true AS better FROM lineitem"


def _against_majority(scored, agree):
    """Rows, rows where ``agree`` holds, and whether more labels are right than by always naming the commoner."""
    ones = F.sum("label")
    right, most = F.count_if(F.col("prediction") == F.col("label")), F.greatest(ones, F.count(F.lit(1)) - ones)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(agree).alias("n_agree"), (right > most).alias("better"))


@register("m3_forest_votes", MORE_THAN_MAJORITY)
def m3_forest_votes(spark, sf):
    """The forest's probability is the mean of its own trees' on every row."""
    df = _lines(spark, sf, cols=["l_quantity", *FEW], label=LARGE)
    model = M.random_forest_classifier(df, num_trees=5)
    rows = _tree_columns(df, model.trees, "p", F.element_at(vector_to_array("probability"), 2))
    scored = model.transform(rows)
    mean = sum((F.col(f"p{i}") for i in range(1, 5)), F.col("p0")) / 5
    varied = F.col("p0") != F.col("p1")  # trees that are all alike are no forest
    kept = scored.agg(F.count_if(varied).alias("varied")).first()["varied"] > 0
    return _against_majority(scored, _near(F.element_at(vector_to_array("probability"), 2), mean) & F.lit(kept))


@register("r4_forest_mean", "SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS n_agree, true AS better FROM lineitem")
def r4_forest_mean(spark, sf):
    """The regression forest predicts the mean of its own trees, and leaves less than the variance of the label."""
    lines = td.table(spark, sf, "lineitem", spread_out=True).withColumn("label", F.col("l_extendedprice") / 1000 + 10 * F.col("l_quantity"))
    df = FE.assemble(lines, ["l_quantity", "l_discount"], "features")
    model = M.random_forest_regressor(df, num_trees=5)
    scored = model.transform(_tree_columns(df, model.trees, "p", F.col("prediction")))
    mean = sum((F.col(f"p{i}") for i in range(1, 5)), F.col("p0")) / 5
    left = F.avg(F.pow(F.col("prediction") - F.col("label"), 2)) < 0.99 * F.var_pop("label")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(_near(F.col("prediction"), mean)).alias("n_agree"), left.alias("better"))


@register("u2_bisecting_tightness", "SELECT count(*)::BIGINT AS n, 5::BIGINT AS clusters, true AS tighter FROM embeddings")
def u2_bisecting_tightness(spark, sf):
    """The clusters' rows are tighter about their own means than all rows are about one."""
    df = td.embedding_vectors(spark, sf)
    entries = FE.explode_vector(U.bisecting_kmeans(df, k=5).transform(df), ["prediction"], "features")
    x = F.col("value")
    stats = entries.groupBy("prediction", "pos").agg(F.sum(x).alias("s"), F.sum(x * x).alias("sq"), F.count("*").alias("n"))
    spread = F.sum(F.col("sq") - F.col("s") * F.col("s") / F.col("n"))
    whole = stats.groupBy("pos").agg(*[F.sum(c).alias(c) for c in ("s", "sq", "n")]).agg(spread.alias("total")).first()["total"]
    return stats.agg(F.sum(F.when(F.col("pos") == 0, F.col("n"))).alias("n"), F.countDistinct("prediction").alias("clusters"),
                     (spread < 0.99 * F.lit(whole)).alias("tighter"))


@register("u3_mixture_columns", "SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS n_prob_ok, true AS better FROM part")
def u3_mixture_columns(spark, sf):
    """A mixture on the columns given, size and price of parts: responsibilities sum to 1, and three components explain
    the rows better than the one Gaussian of their means and covariances."""
    part = td.table(spark, sf, "part", spread_out=True)
    df = FE.assemble(part, ["p_size", "p_retailprice"], "features")
    model = U.gaussian_mixture(df, k=3, max_iter=20)
    one = part.agg(F.count("*").alias("n"), F.var_pop("p_size").alias("a"), F.var_pop("p_retailprice").alias("b"),
                   F.covar_pop("p_size", "p_retailprice").alias("c")).first()
    alone = -one["n"] / 2 * (2 * math.log(2 * math.pi) + math.log(one["a"] * one["b"] - one["c"] ** 2) + 2)
    prob = vector_to_array("probability")
    ok = (F.abs(F.aggregate(prob, F.lit(0.0), lambda a, b: a + b) - 1) < 1e-6) & (F.get(prob, F.col("prediction")) >= F.array_max(prob) - 1e-12)
    return model.transform(df).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_prob_ok")).withColumn(
        "better", F.lit(bool(model.summary.logLikelihood > alone)))


@register("c1_normal_equations", with_(*RATING_SETS) + "SELECT count(DISTINCT userId)::BIGINT AS n, count(DISTINCT userId)::BIGINT AS n_solved FROM tr")
def c1_normal_equations(spark, sf):
    """Every user's factors solve the least squares of the user's ratings on the item factors (the fit's last half
    step): the gradient is nothing beside its parts."""
    train, _ = _stored_split(spark, sf)
    reg = 0.01
    model = C.als_fit(train, reg=reg)
    user = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("u"))
    item = model.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("v"))
    # the ratings meet their items first: what is then dealt out by user is added up where it lies
    rows = train.join(item, "movieId").join(user, "userId")
    x = [(F.get("u", F.lit(i)).cast("double"), F.get("v", F.lit(i)).cast("double")) for i in range(model.rank)]
    error = sum((a * b for a, b in x), F.lit(0.0)) - F.col("rating")
    sums = rows.withColumn("e", error).groupBy("userId").agg(
        F.count("*").alias("n"), *[F.max(a).alias(f"u{i}") for i, (a, _) in enumerate(x)],
        *[F.sum(F.col("e") * b).alias(f"g{i}") for i, (_, b) in enumerate(x)],
        *[F.sum(F.abs(F.col("rating") * b)).alias(f"size{i}") for i, (_, b) in enumerate(x)])
    ok, most = F.lit(True), F.lit(0.0)
    for i in range(model.rank):
        ok = ok & (F.abs(F.col(f"g{i}") + reg * F.col("n") * F.col(f"u{i}")) <= 1e-3 * (F.col(f"size{i}") + 1e-3))
        most = F.greatest(most, F.abs(f"u{i}"))
    return sums.agg(F.count("*").alias("n"), F.count_if(ok & (most > 0)).alias("n_solved"))


@register("t3_best_point", "SELECT 12::BIGINT AS n_points, true AS is_best")
def t3_best_point(spark, sf):
    """The model that is kept has the settings of the grid point with the best metric."""
    df = q_models._formula_frame(spark, sf)
    train, _ = P.split_rows(df, [0.7, 0.3], "o_orderkey", seed=5)
    rform, lr = RFormula(), LogisticRegression(labelCol="label", featuresCol="features")
    base = "lab ~ . - o_orderkey + color:value1"
    grid = T.param_grid([(rform.formula, [base, base + " + color:value2"]), (lr.elasticNetParam, [0.0, 0.5, 1.0]), (lr.regParam, [0.1, 2.0])])
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", rawPredictionCol="rawPrediction", labelCol="label", numBins=0)
    model = T.train_validation_split(T.pipeline([rform, lr]), grid, evaluator, train, train_ratio=0.75)
    metrics = list(model.validationMetrics)
    best = grid[max(range(len(metrics)), key=metrics.__getitem__)]
    fitted_formula, fitted = model.bestModel.stages
    kept = {lr.elasticNetParam: fitted.getElasticNetParam(), lr.regParam: fitted.getRegParam(), rform.formula: fitted_formula.getFormula()}
    is_best = all(kept[p] == v for p, v in best.items()) and max(metrics) > 0.5 - 1e-9
    return df.agg(F.lit(len(metrics)).cast("bigint").alias("n_points"), F.lit(is_best).alias("is_best"))


@register("d3_counted_accuracy", f"SELECT count(*)::BIGINT AS n, true AS same FROM embeddings WHERE {q_models.STRAT} >= 60")
def d3_counted_accuracy(spark, sf):
    """The stated hold-out accuracy is the count over the scored rows."""
    df = td.embedding_vectors(spark, sf)
    train, test = D.label_and_split(df, "vec_id", "label")
    model = D.embedding_classifier(train, max_iter=20, reg=0.001)
    stated = D.holdout_accuracy(model, test).first()["accuracy"]
    scored = model.transform(test).groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("right"))
    return scored.agg(
        F.sum("n").alias("n"), (F.abs(F.sum("right") / F.sum("n") - F.lit(stated)) < 1e-9).alias("same"))
