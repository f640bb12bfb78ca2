"""Checked queries for feature engineering.

Vector outputs are flattened to ``(key, pos, value)`` rows, values rounded
to 4 places on both sides.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry import sources as S
from quarry.operators import features as FE
from quarry.plans import testdata as td
from quarry.plans.registry import register
from quarry.plans.sqlparts import with_
from quarry.session import stage_path


def _r4(c):
    return F.round(c, 4) + F.lit(0.0)


def _flat(df, keys, col, nonzero=False):
    ex = FE.explode_vector(df, keys, col, nonzero)
    return ex.select(*keys, "pos", _r4(F.col("value")).alias("value"))


# ------------------------------------------------------------------ F1 RFormula

RF_BASE = """b AS (SELECT o_orderkey, o_orderstatus AS lab, o_orderpriority AS color,
  CAST(year(o_orderdate) AS INTEGER) AS value1, o_totalprice AS value2 FROM orders),
 lv AS (SELECT color, row_number() OVER (ORDER BY count(*) DESC, color) - 1 AS ci, count(*) OVER () AS k
        FROM b GROUP BY color),
 ll AS (SELECT lab, row_number() OVER (ORDER BY count(*) DESC, lab) - 1 AS li FROM b GROUP BY lab),
 x AS (SELECT b.*, lv.ci, lv.k, ll.li FROM b JOIN lv ON b.color = lv.color JOIN ll ON b.lab = ll.lab)"""


@register(
    "f1_rformula",
    with_(RF_BASE)
    + """, ent AS (
  SELECT o_orderkey, li, ci AS pos, 1.0 AS value FROM x WHERE ci < k - 1
  UNION ALL SELECT o_orderkey, li, k - 1, value1 FROM x
  UNION ALL SELECT o_orderkey, li, k, value2 FROM x
  UNION ALL SELECT o_orderkey, li, k + 1 + ci, value1 FROM x
  UNION ALL SELECT o_orderkey, li, 2 * k + 1 + ci, value2 FROM x)
SELECT o_orderkey, CAST(li AS DOUBLE) AS label, CAST(pos AS INTEGER) AS pos, round(value, 4) + 0.0 AS value
FROM ent WHERE value <> 0""",
)
def f1_rformula(spark, sf):
    orders = td.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("lab"),
        F.col("o_orderpriority").alias("color"),
        F.year("o_orderdate").alias("value1"),
        F.col("o_totalprice").alias("value2"),
    )
    _, out = FE.rformula(orders, "lab ~ . - o_orderkey + color:value1 + color:value2")
    return _flat(out, ["o_orderkey", "label"], "features", nonzero=True)


@register(
    "f2_sql_transform",
    """SELECT c_mktsegment, round(sum(c_acctbal), 4) + 0.0 AS total_bal, count(*)::BIGINT AS n
FROM customer GROUP BY c_mktsegment""",
)
def f2_sql_transform(spark, sf):
    return FE.sql_transform(
        td.table(spark, sf, "customer"),
        "SELECT c_mktsegment, round(sum(c_acctbal), 4) + 0.0 AS total_bal, count(*) AS n "
        "FROM __THIS__ GROUP BY c_mktsegment",
    )


@register(
    "f3_assemble",
    """SELECT c_custkey, 0 AS pos, CAST(c_nationkey AS DOUBLE) AS value FROM customer
UNION ALL SELECT c_custkey, 1, round(c_acctbal, 4) + 0.0 FROM customer""",
)
def f3_assemble(spark, sf):
    out = FE.assemble(td.table(spark, sf, "customer"), ["c_nationkey", "c_acctbal"], "features")
    return _flat(out, ["c_custkey"], "features")


BUCKET_SPLITS = [float("-inf"), 50000.0, 100000.0, 200000.0, 300000.0, float("inf")]


@register(
    "f4_bucketize",
    """SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice < 100000 THEN 1
  WHEN o_totalprice < 200000 THEN 2 WHEN o_totalprice < 300000 THEN 3 ELSE 4 END AS DOUBLE) AS bucket FROM orders""",
)
def f4_bucketize(spark, sf):
    out = FE.bucketize(td.table(spark, sf, "orders"), "o_totalprice", BUCKET_SPLITS, "bucket")
    return out.select("o_orderkey", "bucket")


def _qbucket_sql(n: int) -> str:
    probs = " UNION ALL ".join(
        f"SELECT greatest(1, CAST(ceil({i / n!r} * (SELECT count(*) FROM orders) - 1e-12) AS BIGINT)) AS r"
        for i in range(1, n)
    )
    return f"""WITH c AS (SELECT o_totalprice AS v, count(*) AS cnt FROM orders GROUP BY 1),
  k AS (SELECT v, sum(cnt) OVER (ORDER BY v) AS cum FROM c),
  ps AS ({probs}),
  splits AS (SELECT DISTINCT (SELECT min(v) FROM k WHERE k.cum >= ps.r) AS s FROM ps)
SELECT o_orderkey, CAST((SELECT count(*) FROM splits WHERE s <= o_totalprice) AS DOUBLE) AS bucket FROM orders"""


@register("f5_quantile_buckets", _qbucket_sql(5))
def f5_quantile_buckets(spark, sf):
    out = FE.quantile_buckets(td.table(spark, sf, "orders"), "o_totalprice", 5, "bucket")
    return out.select("o_orderkey", "bucket")


EMB = """emb AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
  unnest(generate_series(0, len(embedding) - 1)) AS pos FROM embeddings)"""


def _emb_vectors(spark, sf):
    return td.embedding_vectors(spark, sf)


@register(
    "f6_standard_scale",
    with_(EMB, "s AS (SELECT pos, stddev_samp(x) AS sd FROM emb GROUP BY pos)")
    + """SELECT vec_id, pos::INTEGER AS pos, round(CASE WHEN sd = 0 THEN 0.0 ELSE x / sd END, 4) + 0.0 AS value
FROM emb JOIN s USING (pos)""",
)
def f6_standard_scale(spark, sf):
    return _flat(FE.standard_scale(_emb_vectors(spark, sf), "features", "scaled"), ["vec_id"], "scaled")


@register(
    "f7_minmax_scale",
    with_(EMB, "s AS (SELECT pos, min(x) AS lo, max(x) AS hi FROM emb GROUP BY pos)")
    + """SELECT vec_id, pos::INTEGER AS pos,
  round(CASE WHEN hi = lo THEN 7.5 ELSE (x - lo) / (hi - lo) * 5.0 + 5.0 END, 4) + 0.0 AS value
FROM emb JOIN s USING (pos)""",
)
def f7_minmax_scale(spark, sf):
    return _flat(FE.minmax_scale(_emb_vectors(spark, sf), "features", "scaled", 5.0, 10.0), ["vec_id"], "scaled")


@register(
    "f8_maxabs_scale",
    with_(EMB, "s AS (SELECT pos, max(abs(x)) AS m FROM emb GROUP BY pos)")
    + """SELECT vec_id, pos::INTEGER AS pos, round(CASE WHEN m = 0 THEN 0.0 ELSE x / m END, 4) + 0.0 AS value
FROM emb JOIN s USING (pos)""",
)
def f8_maxabs_scale(spark, sf):
    return _flat(FE.maxabs_scale(_emb_vectors(spark, sf), "features", "scaled"), ["vec_id"], "scaled")


def product_weights(dim: int) -> list[float]:
    """Weights that rise by an eighth per dimension, from a half."""
    return [0.5 + i / 8 for i in range(dim)]


@register(
    "f9_elementwise_product",
    with_(EMB) + "SELECT vec_id, pos::INTEGER AS pos, round(x * (0.5::DOUBLE + pos / 8), 4) + 0.0 AS value FROM emb",
)
def f9_elementwise_product(spark, sf):
    df = _emb_vectors(spark, sf)
    dim = len(df.select("features").first()[0])
    return _flat(FE.elementwise_product(df, "features", product_weights(dim), "scaled"), ["vec_id"], "scaled")


@register(
    "f10_normalize",
    with_(EMB, "s AS (SELECT vec_id, sum(abs(x)) AS nrm FROM emb GROUP BY vec_id)")
    + """SELECT vec_id, pos::INTEGER AS pos, round(CASE WHEN nrm = 0 THEN x ELSE x / nrm END, 4) + 0.0 AS value
FROM emb JOIN s USING (vec_id)""",
)
def f10_normalize(spark, sf):
    return _flat(FE.normalize(_emb_vectors(spark, sf), "features", "scaled", p=1.0), ["vec_id"], "scaled")


@register(
    "f11_index_strings",
    """WITH lv AS (SELECT CAST(p_size AS VARCHAR) AS v,
  row_number() OVER (ORDER BY count(*) DESC, CAST(p_size AS VARCHAR)) - 1 AS idx FROM part GROUP BY 1)
SELECT p_partkey, CAST(idx AS DOUBLE) AS size_idx FROM part JOIN lv ON CAST(p_size AS VARCHAR) = lv.v""",
)
def f11_index_strings(spark, sf):
    _, out = FE.index_strings(td.table(spark, sf, "part"), "p_size", "size_idx")
    return out.select("p_partkey", "size_idx")


CUSTOMER_INDEX = """lv AS (SELECT CAST(o_custkey AS VARCHAR) AS v,
  row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS idx FROM orders {0} GROUP BY 1)
SELECT o_orderkey, CAST(idx AS DOUBLE) AS customer_idx FROM orders JOIN lv ON CAST(o_custkey AS VARCHAR) = lv.v"""


@register("f11_index_customers", "WITH " + CUSTOMER_INDEX.format(""))
def f11_index_customers(spark, sf):
    """Customer ids as categories: a dictionary table of any size, joined with the hot values apart."""
    orders = td.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = FE.encode_strings(orders, FE.label_dictionary(orders, "o_custkey"), "o_custkey", "customer_idx")
    return out.select("o_orderkey", "customer_idx")


@register("f11_skip_unseen", "WITH " + CUSTOMER_INDEX.format("WHERE o_orderstatus = 'F'"))
def f11_skip_unseen(spark, sf):
    """A dictionary of the customers of finished orders; orders of other customers are skipped."""
    orders = td.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    known = FE.label_dictionary(orders.where("o_orderstatus = 'F'"), "o_custkey")
    return FE.encode_strings(orders, known, "o_custkey", "customer_idx", "skip").select("o_orderkey", "customer_idx")


@register("f12_unindex", "SELECT p_partkey, p_type, p_type AS restored FROM part")
def f12_unindex(spark, sf):
    _, idx = FE.index_strings(td.table(spark, sf, "part"), "p_type", "type_idx")
    return FE.unindex(idx, "type_idx", "restored").select("p_partkey", "p_type", "restored")


@register(
    "f13_index_vector",
    """WITH r1 AS (SELECT l_tax AS v, dense_rank() OVER (ORDER BY l_tax) - 1 AS ix FROM (SELECT DISTINCT l_tax FROM lineitem)),
  r0 AS (SELECT l_linenumber AS v, dense_rank() OVER (ORDER BY l_linenumber) - 1 AS ix
         FROM (SELECT DISTINCT l_linenumber FROM lineitem))
SELECT l_orderkey, l_partkey, 0 AS pos, CAST(r0.ix AS DOUBLE) AS value FROM lineitem JOIN r0 ON l_linenumber = r0.v
UNION ALL SELECT l_orderkey, l_partkey, 1, CAST(r1.ix AS DOUBLE) FROM lineitem JOIN r1 ON l_tax = r1.v
UNION ALL SELECT l_orderkey, l_partkey, 2, round(l_discount, 4) + 0.0 FROM lineitem""",
)
def f13_index_vector(spark, sf):
    lines = td.table(spark, sf, "lineitem")
    df = FE.assemble(lines, ["l_linenumber", "l_tax", "l_discount"], "raw")
    out = FE.index_vector(df, "raw", "idxed", max_categories=10)
    return _flat(out, ["l_orderkey", "l_partkey"], "idxed")


@register(
    "f14_one_hot",
    """WITH lv AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx,
  count(*) OVER () AS k FROM part GROUP BY p_type)
SELECT p_partkey, CAST(idx AS INTEGER) AS pos, CAST(1.0 AS DOUBLE) AS value FROM part JOIN lv USING (p_type)
WHERE idx < k - 1""",
)
def f14_one_hot(spark, sf):
    _, idx = FE.index_strings(td.table(spark, sf, "part"), "p_type", "type_idx")
    out = FE.one_hot(idx, "type_idx", "type_vec")
    return _flat(out, ["p_partkey"], "type_vec", nonzero=True)


PCA_SQL = """WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
 c AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS d FROM p),
 ev AS (SELECT a, b, d, (a + d) / 2 + sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS l1 FROM c),
 v AS (SELECT b / sqrt(b * b + (l1 - a) * (l1 - a)) AS u, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS w FROM ev),
 s1 AS (SELECT CASE WHEN (abs(u) >= abs(w) AND u < 0) OR (abs(w) > abs(u) AND w < 0) THEN -1 ELSE 1 END AS g, u, w FROM v),
 c1 AS (SELECT g * u AS u1, g * w AS w1 FROM s1),
 s2 AS (SELECT -w1 AS u2r, u1 AS w2r FROM c1),
 c2 AS (SELECT CASE WHEN (abs(u2r) >= abs(w2r) AND u2r < 0) OR (abs(w2r) > abs(u2r) AND w2r < 0) THEN -u2r ELSE u2r END AS u2,
               CASE WHEN (abs(u2r) >= abs(w2r) AND u2r < 0) OR (abs(w2r) > abs(u2r) AND w2r < 0) THEN -w2r ELSE w2r END AS w2
        FROM s2)
SELECT vec_id, 0 AS pos, round(x * u1 + y * w1, 4) + 0.0 AS value FROM p, c1
UNION ALL SELECT vec_id, 1, round(x * u2 + y * w2, 4) + 0.0 FROM p, c2"""


def _two_dims(spark, sf):
    from pyspark.ml.functions import array_to_vector

    return td.table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.slice("embedding", 1, 2)).alias("features")
    )


@register("f15_pca", PCA_SQL)
def f15_pca(spark, sf):
    return _flat(FE.pca(_two_dims(spark, sf), "features", 2, "pcs"), ["vec_id"], "pcs")


SQUARES_SQL = """SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 4) + 0.0 AS squares
FROM embeddings"""


def squares(df, model, width):
    """Sum of squares of every row turned onto all components (a rotation keeps
    it); null if the first two components are correlated."""
    from pyspark.ml.functions import vector_to_array

    turned = FE.pca_project(df, "features", model, "turned").select("vec_id", vector_to_array("turned").alias("t"))
    related = turned.agg(F.corr(F.get("t", F.lit(0)), F.get("t", F.lit(width - 1))).alias("r")).first()["r"]
    total = F.aggregate("t", F.lit(0.0), lambda acc, x: acc + x * x)
    return turned.select("vec_id", F.when(F.abs(F.lit(related)) < 1e-6, F.round(total, 4) + 0.0).alias("squares"))


def whole_vectors(spark, sf):
    """The embeddings as vectors, and their width."""
    from pyspark.ml.functions import array_to_vector

    rows = td.table(spark, sf, "embeddings")
    width = rows.agg(F.max(F.size("embedding")).alias("d")).first()["d"]
    return rows.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")), width


@register("f15_pca_full", SQUARES_SQL)
def f15_pca_full(spark, sf):
    """All components of the whole vectors."""
    df, width = whole_vectors(spark, sf)
    return squares(df, FE.fit_pca(df, "features", width), width)


WIDE_K = 5


@register(
    "f15_pca_wide",
    f"""SELECT CAST(pos - 1 AS INTEGER) AS pos, round(var_samp(x), 6) + 0.0 AS variance, {WIDE_K}::BIGINT AS held
FROM (SELECT unnest(range(1, len(embedding) + 1)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY pos""",
)
def f15_pca_wide(spark, sf):
    """Per column of the embeddings its variance, and for how many components of length 1 the column's covariance with
    the projected rows is the component's variance times its loading, which is what makes it a principal component."""
    df, _ = whole_vectors(spark, sf)
    fit = FE.fit_pca_wide(df, "features", WIDE_K)
    turned = FE.pca_project(df, "features", fit, "t").select(vector_to_array("features").alias("x"), vector_to_array("t").alias("t"))
    cells = turned.select(F.posexplode("x").alias("pos", "v"), "t")
    moments = cells.groupBy("pos").agg(
        F.var_samp("v").alias("variance"), *[F.covar_samp("v", F.get("t", F.lit(j))).alias(f"c{j}") for j in range(WIDE_K)])
    expected = spark.createDataFrame(
        [(i, *map(float, row)) for i, row in enumerate(fit.loadings * fit.variances)],
        ["pos", *[f"e{j}" for j in range(WIDE_K)]])  # one row per column
    unit = [bool(abs(float((fit.loadings[:, j] ** 2).sum()) - 1) < 1e-9) for j in range(fit.loadings.shape[1])]
    held = sum(
        ((F.abs(F.col(f"c{j}") - F.col(f"e{j}")) < 1e-9) & (F.lit(float(fit.variances[j])) > 0) & F.lit(unit[j])).cast("long")
        for j in range(len(unit)))
    return moments.join(expected, "pos").select(
        F.col("pos").cast("int").alias("pos"), (F.round("variance", 6) + 0.0).alias("variance"), held.alias("held"))


@register("k3_save_load_model", SQUARES_SQL)
def k3_save_load_model(spark, sf):
    """A fitted model of the whole vectors, saved, loaded and applied."""
    df, width = whole_vectors(spark, sf)
    path = stage_path(spark, "models", f"pca-{hashlib.md5(sf.encode()).hexdigest()[:8]}")
    S.save_model(FE.fit_pca(df, "features", width), path)
    return squares(df, S.load_model(PCAModel, path), width)


@register(
    "f16_poly_expand",
    """SELECT p_partkey, 0 AS pos, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 1, CAST(p_size * p_size AS DOUBLE) FROM part
UNION ALL SELECT p_partkey, 2, round(p_retailprice, 4) + 0.0 FROM part
UNION ALL SELECT p_partkey, 3, round(p_size * p_retailprice, 4) + 0.0 FROM part
UNION ALL SELECT p_partkey, 4, round(p_retailprice * p_retailprice, 4) + 0.0 FROM part""",
)
def f16_poly_expand(spark, sf):
    df = FE.assemble(td.table(spark, sf, "part"), ["p_size", "p_retailprice"], "raw")
    return _flat(FE.poly_expand(df, "raw", "poly", 2), ["p_partkey"], "poly")


CHI_LABEL = "CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS DOUBLE)"


@register(
    "f17_chi2_select",
    f"""WITH b AS (SELECT {CHI_LABEL} AS label, CAST(l_linenumber AS DOUBLE) AS f0, l_discount AS f1, l_tax AS f2
  FROM lineitem),
 lg AS (SELECT 0 AS feature, f0 AS v, label FROM b UNION ALL SELECT 1, f1, label FROM b
        UNION ALL SELECT 2, f2, label FROM b),
 obs AS (SELECT feature, v, label, count(*) AS o FROM lg GROUP BY ALL),
 rv AS (SELECT feature, v, sum(o) AS rt FROM obs GROUP BY ALL),
 cl AS (SELECT feature, label, sum(o) AS ct FROM obs GROUP BY ALL),
 tot AS (SELECT feature, sum(o) AS n FROM obs GROUP BY feature),
 grid AS (SELECT rv.feature, rv.v, cl.label, CAST(rv.rt AS DOUBLE) * cl.ct / tot.n AS e
          FROM rv JOIN cl ON rv.feature = cl.feature JOIN tot ON tot.feature = rv.feature)
SELECT CAST(g.feature AS INTEGER) AS featureIndex,
  round(sum((coalesce(o.o, 0) - g.e) * (coalesce(o.o, 0) - g.e) / g.e), 4) + 0.0 AS statistic,
  CAST((count(DISTINCT g.v) - 1) * (count(DISTINCT g.label) - 1) AS INTEGER) AS degreesOfFreedom
FROM grid g LEFT JOIN obs o ON o.feature = g.feature AND o.v = g.v AND o.label = g.label
GROUP BY g.feature""",
)
def f17_chi2_select(spark, sf):
    lines = td.table(spark, sf, "lineitem").withColumn("label", F.expr(CHI_LABEL))
    df = FE.assemble(lines, ["l_linenumber", "l_discount", "l_tax"], "features")
    res = FE.chi2_test(df, "features", "label")
    return res.select("featureIndex", _r4(F.col("statistic")).alias("statistic"), "degreesOfFreedom")


@register(
    "f17_contingency",
    f"""WITH b AS (SELECT {CHI_LABEL} AS label, CAST(l_linenumber - 1 AS DOUBLE) AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem),
 lg AS (SELECT 0 AS feature, f0 AS value, label FROM b UNION ALL SELECT 1, f1, label FROM b UNION ALL SELECT 2, f2, label FROM b)
SELECT feature, round(value, 4) + 0.0 AS value, CAST(label AS VARCHAR) AS label, count(*)::BIGINT AS n FROM lg GROUP BY ALL""",
)
def f17_contingency(spark, sf):
    """Counts per feature, value and label; zeros follow from the labels' totals."""
    lines = td.table(spark, sf, "lineitem").withColumn("label", F.expr(CHI_LABEL)).withColumn("place", F.col("l_linenumber") - 1)
    df = FE.assemble(lines, ["place", "l_discount", "l_tax"], "features")
    return FE.contingency(df, "features", "label").select("feature", _r4(F.col("value")).alias("value"), "label", "n")


@register(
    "f17_chi2_selected",
    """SELECT o_orderkey, CAST(c_nationkey AS DOUBLE) AS value
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def f17_chi2_selected(spark, sf):
    """The feature most dependent on the customer: of priority, nation and status, the nation."""
    nations = td.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = td.table(spark, sf, "orders").join(nations, "o_custkey").select(
        "o_orderkey", "o_custkey", F.ascii("o_orderpriority").alias("priority"), "c_nationkey",
        F.ascii("o_orderstatus").alias("status"))
    df = FE.assemble(rows, ["priority", "c_nationkey", "status"], "features")
    kept = FE.chi2_select(df, "features", "o_custkey", 1, "kept")
    return FE.explode_vector(kept, ["o_orderkey"], "kept").select("o_orderkey", "value")
