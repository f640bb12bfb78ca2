"""Checked queries for projections, filters, aggregations, sorts, set
operations and scalar functions (P, A, O, Q, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as L
from quarry.operators import graph as G
from quarry.operators import shaping as P
from quarry.plans import testdata as td
from quarry.plans.registry import register
from quarry.plans.sqlparts import RATINGS, TRADE_EDGES, with_


def _r4(c):
    return F.round(c, 4) + F.lit(0.0)


# ------------------------------------------------------------------ projections


@register(
    "p1_select_expr",
    """SELECT l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount), 4) + 0.0 AS revenue,
       CAST(l_quantity AS INTEGER) AS qty FROM lineitem""",
)
def p1_select_expr(spark, sf):
    return P.select_expr(
        td.table(spark, sf, "lineitem"),
        "l_orderkey",
        "l_partkey",
        "round(l_extendedprice * (1 - l_discount), 4) + 0.0 AS revenue",
        "cast(l_quantity AS int) AS qty",
    )


@register("p2_select", "SELECT o_orderkey, o_totalprice FROM orders")
def p2_select(spark, sf):
    return td.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@register("p3_rename", "SELECT c_custkey AS id, c_name AS name, c_nationkey FROM customer")
def p3_rename(spark, sf):
    cust = td.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return P.rename(cust, {"c_custkey": "id", "c_name": "name"})


@register("p4_add_constant", "SELECT doc_id, 1 AS label FROM labels WHERE toxic = 1")
def p4_add_constant(spark, sf):
    toxic = td.table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    return P.add_constant(toxic, "label", 1)


@register("p5_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def p5_drop_columns(spark, sf):
    return P.drop_columns(td.table(spark, sf, "orders"), "O_TOTALPRICE", "o_OrderPriority")


@register(
    "p6_filter_not_null",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL""",
)
def p6_filter_not_null(spark, sf):
    docs = td.table(spark, sf, "documents").select("doc_id")
    joined = docs.join(td.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return P.not_null(joined, "quality")


@register(
    "p7_filter_compare",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem
WHERE (l_returnflag = 'R' OR l_linestatus != 'O') AND l_quantity < 10""",
)
def p7_filter_compare(spark, sf):
    return (
        td.table(spark, sf, "lineitem")
        .where("(l_returnflag = 'R' OR l_linestatus != 'O') AND l_quantity < 10")
        .select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    )


@register(
    "p8_filter_token",
    r"""SELECT doc_id FROM documents WHERE list_contains(string_split_regex(lower(text), '\s'), 'spark')
   OR list_contains(string_split_regex(lower(text), '\s'), 'the')""",
)
def p8_filter_token(spark, sf):
    docs = td.table(spark, sf, "documents").select("doc_id", L.whitespace_tokens("text").alias("tokens"))
    hit = docs.where(F.array_contains("tokens", "spark") | F.array_contains("tokens", "the"))
    return hit.select("doc_id")


@register(
    "p9_nested_field",
    with_(TRADE_EDGES) + "SELECT src AS a_id, item AS ab_item, dst AS b_id FROM trade_edges",
)
def p9_nested_field(spark, sf):
    m = G.find_motif(td.trade_graph(spark, sf), "(a)-[ab]->(b)")
    return m.select(F.col("a.id").alias("a_id"), F.col("ab.item").alias("ab_item"), F.col("b.id").alias("b_id"))


@register(
    "p10_array_element",
    """SELECT c_custkey, CAST(string_split(c_name, '#')[2] AS BIGINT) AS number,
       CAST(string_split(c_name, '#')[6] AS VARCHAR) AS missing FROM customer""",
)
def p10_array_element(spark, sf):
    parts = L.split_regex("c_name", "#")
    return td.table(spark, sf, "customer").select(
        "c_custkey",
        L.safe_cast(L.array_element(parts, 1), "bigint").alias("number"),
        L.array_element(parts, 5).alias("missing"),
    )


@register(
    "p11_explode",
    """SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'price', l_extendedprice FROM lineitem""",
)
def p11_explode(spark, sf):
    """Array-of-struct column built per row (no grouping), then one row per struct."""
    lines = td.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array(
            F.struct(F.lit("quantity").alias("measure"), F.col("l_quantity").alias("amount")),
            F.struct(F.lit("price").alias("measure"), F.col("l_extendedprice").alias("amount")),
        ).alias("measures"),
    )
    return P.explode_structs(lines, ["l_orderkey", "l_linenumber"], "measures")


SPLIT_SQL = """SELECT o_orderkey,
  CASE WHEN (('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 1, 7))::BIGINT % 100) < 70 THEN 0 ELSE 1 END
    AS split
FROM orders"""


@register("p12_split_rows", SPLIT_SQL)
def p12_split_rows(spark, sf):
    orders = td.table(spark, sf, "orders").select("o_orderkey")
    return P.split_column(orders, [0.7, 0.3], "o_orderkey", seed=7)


@register(
    "p12_split_small",
    """SELECT o_orderkey FROM orders
WHERE (('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 1, 7))::BIGINT % 100)
      + ('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 8, 7))::BIGINT / 268435456.0::DOUBLE >= 99.9""",
)
def p12_split_small(spark, sf):
    """The second part of a 99.9 / 0.1 percent split."""
    return P.split_rows(td.table(spark, sf, "orders").select("o_orderkey"), [0.999, 0.001], "o_orderkey", seed=7)[1]


# ------------------------------------------------------------------ aggregations


@register(
    "a1_group_count",
    "SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS count FROM lineitem GROUP BY 1, 2",
)
def a1_group_count(spark, sf):
    return td.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("count")
    )


@register(
    "a2_sql_sum_count",
    """SELECT l.quality, sum(d.n_chars)::BIGINT AS sum_chars, count(*)::BIGINT AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality""",
)
def a2_sql_sum_count(spark, sf):
    docs = td.table(spark, sf, "documents").join(td.table(spark, sf, "labels"), "doc_id", "left")
    return spark.sql(
        "SELECT quality, sum(n_chars) AS sum_chars, count(*) AS n FROM {this} GROUP BY quality", this=docs
    )


@register("a3_global_count", "SELECT count(*)::BIGINT AS n FROM lineitem")
def a3_global_count(spark, sf):
    return td.table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@register("a4_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def a4_distinct(spark, sf):
    return td.table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


QUANTILE_PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _quantile_sql(table: str, col: str, probs) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {float(p)!r}::DOUBLE AS p, greatest(1, CAST(ceil({float(p)!r} * (SELECT count(*) FROM {table} "
        f"WHERE {col} IS NOT NULL) - 1e-12) AS BIGINT)) AS r"
        for p in probs
    )
    return f"""WITH c AS (SELECT {col} AS v, count(*) AS cnt FROM {table} WHERE {col} IS NOT NULL GROUP BY 1),
  k AS (SELECT v, sum(cnt) OVER (ORDER BY v) AS cum FROM c),
  ps AS ({rows})
SELECT ps.p, (SELECT min(v) FROM k WHERE k.cum >= ps.r) AS value FROM ps"""


@register("a5_quantiles", _quantile_sql("orders", "o_totalprice", QUANTILE_PROBS))
def a5_quantiles(spark, sf):
    return P.exact_quantiles(td.table(spark, sf, "orders"), "o_totalprice", QUANTILE_PROBS)


RANK_ERROR = 0.002


@register(
    "a5_approx_quantiles",
    f"""SELECT o_orderpriority, unnest([{", ".join(f"{float(p)!r}::DOUBLE" for p in QUANTILE_PROBS)}]) AS p,
  count(o_totalprice)::BIGINT AS n, true AS within FROM orders GROUP BY o_orderpriority""",
)
def a5_approx_quantiles(spark, sf):
    """Quantiles per priority from mergeable summaries; ``within``: the value's ranks, counted, reach to the stated
    error of the asked one."""
    orders = td.table(spark, sf, "orders").select("o_orderpriority", "o_totalprice")
    found = P.approx_quantiles(orders, "o_totalprice", QUANTILE_PROBS, RANK_ERROR, ["o_orderpriority"])
    below, upto = F.count_if(F.col("o_totalprice") < F.col("value")), F.count_if(F.col("o_totalprice") <= F.col("value"))
    ranked = orders.join(found, "o_orderpriority").groupBy("o_orderpriority", "p", "n").agg(below.alias("below"), upto.alias("upto"))
    asked, error = F.col("p") * F.col("n"), F.ceil(F.col("n") * RANK_ERROR)
    within = (F.col("below") < F.col("upto")) & (F.col("below") <= asked + error) & (F.col("upto") >= asked - error)
    return ranked.select("o_orderpriority", "p", "n", within.alias("within"))


EMB_UNNEST = """emb AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
  unnest(generate_series(0, len(embedding) - 1)) AS pos FROM embeddings)"""


@register(
    "a6_column_stats",
    with_(EMB_UNNEST)
    + """SELECT pos::INTEGER AS pos, round(min(x), 4) + 0.0 AS min, round(max(x), 4) + 0.0 AS max,
  round(max(abs(x)), 4) + 0.0 AS max_abs, round(avg(x), 4) + 0.0 AS mean, round(stddev_samp(x), 4) + 0.0 AS std
FROM emb GROUP BY pos""",
)
def a6_column_stats(spark, sf):
    stats = P.column_stats(td.embedding_vectors(spark, sf), "features")
    return stats.select("pos", *[_r4(F.col(c)).alias(c) for c in ("min", "max", "max_abs", "mean", "std")])


@register(
    "a7_label_frequency",
    """SELECT value, count, (row_number() OVER (ORDER BY count DESC, value ASC) - 1)::BIGINT AS index
FROM (SELECT p_type AS value, count(*)::BIGINT AS count FROM part GROUP BY 1) t""",
)
def a7_label_frequency(spark, sf):
    return P.label_frequency(td.table(spark, sf, "part"), "p_type")


# ------------------------------------------------------------------ sorts and limits


@register("o1_sort", "SELECT o_orderkey, o_totalprice FROM orders")
def o1_sort(spark, sf):
    return td.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    )


@register(
    "o2_sort_expr",
    """SELECT o_orderkey, CAST(epoch(max(l.l_shipdate)) - epoch(o.o_orderdate) AS BIGINT) AS lag_s
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o_orderkey, o_orderdate""",
)
def o2_sort_expr(spark, sf):
    orders = td.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    last = td.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("last_ship")
    )
    lag = L.epoch_seconds("last_ship") - L.epoch_seconds("o_orderdate")
    return orders.join(last, "o_orderkey").select("o_orderkey", lag.alias("lag_s")).orderBy(lag.desc(), "o_orderkey")


@register(
    "o3_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def o3_limit(spark, sf):
    orders = td.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return P.top_n(orders, 10, F.desc("o_totalprice"), "o_orderkey")


@register(
    "o4_topk_per_group",
    with_(RATINGS)
    + """SELECT userId, movieId, round(CAST(rating AS DOUBLE), 4) + 0.0 AS rating, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY rating DESC, movieId) AS rank FROM ratings) t
WHERE rank <= 3""",
)
def o4_topk_per_group(spark, sf):
    top = P.top_k_per_group(td.ratings(spark, sf), ["userId"], [F.desc("rating"), "movieId"], 3)
    return top.select("userId", "movieId", _r4(F.col("rating").cast("double")).alias("rating"), "rank")


# ------------------------------------------------------------------ set operations


@register(
    "q1_union",
    """SELECT doc_id, 1 AS label FROM labels WHERE toxic = 1
UNION ALL SELECT doc_id, 0 AS label FROM labels WHERE toxic = 0""",
)
def q1_union(spark, sf):
    lab = td.table(spark, sf, "labels")
    pos = P.add_constant(lab.where("toxic = 1").select("doc_id"), "label", 1)
    neg = P.add_constant(lab.where("toxic = 0").select("doc_id"), "label", 0)
    return pos.unionByName(neg)


@register("q2_distinct", with_(TRADE_EDGES) + "SELECT DISTINCT src, dst FROM trade_edges")
def q2_distinct(spark, sf):
    return td.trade_graph(spark, sf).edges.select("src", "dst").distinct()


# ------------------------------------------------------------------ scalar functions


@register(
    "l1_cast",
    """SELECT c_custkey, TRY_CAST(c_mktsegment AS INTEGER) AS seg_num, CAST(c_nationkey AS BIGINT) AS nation_long,
       CAST(c_acctbal AS FLOAT) AS bal_float FROM customer""",
)
def l1_cast(spark, sf):
    return td.table(spark, sf, "customer").select(
        "c_custkey",
        L.safe_cast("c_mktsegment", "int").alias("seg_num"),
        F.col("c_nationkey").cast("bigint").alias("nation_long"),
        F.col("c_acctbal").cast("float").alias("bal_float"),
    )


@register(
    "l2_ratio",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) / NULLIF(CAST(o_custkey AS DOUBLE), 0) AS ratio
FROM orders""",
)
def l2_ratio(spark, sf):
    return td.table(spark, sf, "orders").select("o_orderkey", L.ratio("o_totalprice", "o_custkey").alias("ratio"))


@register(
    "l3_split",
    "SELECT page_id, len(string_split_regex(url, '[/?&]'))::INTEGER AS n_parts FROM pages",
)
def l3_split(spark, sf):
    return td.table(spark, sf, "pages").select(
        "page_id", F.size(L.split_regex("url", "[/?&]", literal=False)).alias("n_parts")
    )


@register(
    "l4_array_index",
    r"""SELECT doc_id, string_split_regex(lower(text), '\s')[1] AS first_token,
  list_contains(string_split_regex(lower(text), '\s'), 'and') AS has_and FROM documents""",
)
def l4_array_index(spark, sf):
    toks = L.whitespace_tokens("text")
    return td.table(spark, sf, "documents").select(
        "doc_id", L.array_element(toks, 0).alias("first_token"), F.array_contains(toks, "and").alias("has_and")
    )


@register(
    "l5_timestamp_parse",
    """SELECT o_orderkey, strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS text,
  CAST(epoch(o_orderdate) AS BIGINT) AS epoch_s FROM orders""",
)
def l5_timestamp_parse(spark, sf):
    text = F.date_format("o_orderdate", td.DATE_FMT)
    orders = td.table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return orders.select("o_orderkey", "text", L.epoch_seconds(L.parse_timestamp("text", td.DATE_FMT)).alias("epoch_s"))


@register(
    "l6_lit_expr",
    "SELECT o_orderkey, 'orders' AS source, o_totalprice > 100000 AS big FROM orders",
)
def l6_lit_expr(spark, sf):
    return td.table(spark, sf, "orders").select(
        "o_orderkey", F.lit("orders").alias("source"), F.expr("o_totalprice > 100000").alias("big")
    )


@register(
    "l7_predicates",
    """SELECT count(*) FILTER (WHERE quality IS NOT NULL)::BIGINT AS n_not_null,
  count(*) FILTER (WHERE quality = 1 OR toxic != 0)::BIGINT AS n_or,
  count(*) FILTER (WHERE quality < 1)::BIGINT AS n_lt
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def l7_predicates(spark, sf):
    d = td.table(spark, sf, "documents").select("doc_id").join(td.table(spark, sf, "labels"), "doc_id", "left")
    return d.agg(
        F.count_if(F.col("quality").isNotNull()).alias("n_not_null"),
        F.count_if((F.col("quality") == 1) | (F.col("toxic") != 0)).alias("n_or"),
        F.count_if(F.col("quality") < 1).alias("n_lt"),
    )


@register(
    "l8_lower_split",
    r"""SELECT conv_id, turn, len(string_split_regex(lower(text), '\s'))::INTEGER AS n_tokens FROM conversations""",
)
def l8_lower_split(spark, sf):
    return td.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.size(L.whitespace_tokens("text")).alias("n_tokens")
    )


# ------------------------------------------------------------------ cache and partition control


@register(
    "p13_cache_control",
    """SELECT 'orders' AS part, count(*)::BIGINT AS n FROM orders
UNION ALL SELECT 'open', count(*)::BIGINT FROM orders WHERE o_orderstatus = 'O'""",
)
def p13_cache_control(spark, sf):
    """One scan reused by two aggregations inside a persist / unpersist block."""
    orders = td.table(spark, sf, "orders").select("o_orderstatus")
    with P.cached(orders) as o:
        total = o.agg(F.count(F.lit(1)).alias("n")).select(F.lit("orders").alias("part"), "n")
        open_ = o.where("o_orderstatus = 'O'").agg(F.count(F.lit(1)).alias("n")).select(F.lit("open").alias("part"), "n")
        rows = total.unionByName(open_).collect()
    return spark.createDataFrame(rows, "part string, n bigint")


@register(
    "p14_partition_control",
    "SELECT o_custkey, count(*)::BIGINT AS n_orders, round(sum(o_totalprice), 4) + 0.0 AS total FROM orders GROUP BY 1",
)
def p14_partition_control(spark, sf):
    """The aggregation combines before its exchange; its result is then dealt
    into balanced partitions on the key (a hot one is split, small ones merged)."""
    totals = td.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), (F.round(F.sum("o_totalprice"), 4) + 0.0).alias("total")
    )
    return totals.hint("rebalance", "o_custkey")
