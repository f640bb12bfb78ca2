"""Checked queries for sources and sinks.

Inputs are derived from the driver tables, written to the shared scratch
folder in the format under test, and read back with the operator; the
oracle reads the original table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry import sources as S
from quarry.operators import graph as G
from quarry.plans import testdata as td
from quarry.plans.registry import register
from quarry.plans.sqlparts import TRADE_EDGES, with_
from quarry.plans.staging import stage
from quarry.session import stage_path

CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@register("s1_read_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1_read_csv(spark, sf):
    path = stage(spark, sf, "customer_csv", td.table(spark, sf, "customer"), "csv", header="true")
    return S.read_csv(spark, f"{path}/*.csv", schema=CUSTOMER_SCHEMA)


@register(
    "s2_read_csv_infer",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def s2_read_csv_infer(spark, sf):
    part = td.table(spark, sf, "part")
    path = stage(spark, sf, "part_csv", part, "csv", header="true")
    df = S.read_csv(spark, f"{path}/part-*.csv", infer=True)
    return df.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_name",
        "p_brand",
        "p_type",
        F.col("p_size").cast("int").alias("p_size"),
        F.col("p_retailprice").cast("double").alias("p_retailprice"),
    )


@register(
    "s3_read_json",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def s3_read_json(spark, sf):
    path = stage(spark, sf, "orders_json", td.table(spark, sf, "orders"), "json")
    df = S.read_json(spark, path)
    return df.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        "o_orderpriority",
    )


@register("s4_read_parquet", "SELECT * FROM lineitem")
def s4_read_parquet(spark, sf):
    return S.read_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet")


RATING_FIELDS = [("userId", "int"), ("movieId", "int"), ("rating", "float"), ("timestamp", "bigint")]


@register(
    "s5_read_delimited",
    """SELECT CAST(o.o_custkey AS INTEGER) AS userId, CAST(l.l_partkey AS INTEGER) AS movieId,
       round(CAST(CAST(avg(CAST(least(ceil(l.l_quantity / 10), 5) AS DOUBLE)) AS FLOAT) AS DOUBLE), 4) + 0.0 AS rating,
       CAST(epoch(max(l.l_shipdate)) AS BIGINT) AS timestamp
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""",
)
def s5_read_delimited(spark, sf):
    orders = td.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = td.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity", "l_shipdate"
    )
    text = (
        lines.join(orders, "o_orderkey")
        .groupBy("o_custkey", "l_partkey")
        .agg(
            F.avg(F.least(F.ceil(F.col("l_quantity") / 10), F.lit(5)).cast("double")).cast("float").alias("r"),
            F.unix_timestamp(F.max("l_shipdate")).alias("t"),
        )
        .select(F.concat_ws("::", "o_custkey", "l_partkey", F.col("r").cast("string"), "t").alias("value"))
    )
    path = stage(spark, sf, "ratings_txt", text, "text")
    df = S.read_delimited(spark, path, RATING_FIELDS, sep="::")
    return df.select("userId", "movieId", (F.round(F.col("rating").cast("double"), 4) + 0.0).alias("rating"), "timestamp")


# Order status codes and their descriptions.
STATUS_ROWS = [("F", "finished"), ("O", "open"), ("P", "partial")]


@register(
    "s6_rows",
    """SELECT s.status_text, count(*)::BIGINT AS n_orders
FROM orders o JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) s(status, status_text)
  ON o.o_orderstatus = s.status GROUP BY s.status_text""",
)
def s6_rows(spark, sf):
    lookup = S.rows(spark, STATUS_ROWS, ["status", "status_text"])
    orders = td.table(spark, sf, "orders")
    return (
        orders.join(F.broadcast(lookup), orders.o_orderstatus == lookup.status)
        .groupBy("status_text")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@register("s7_sequence", "SELECT CAST(range AS DOUBLE) AS id FROM range((SELECT count(*) FROM orders))")
def s7_sequence(spark, sf):
    n = td.table(spark, sf, "orders").count()
    return S.sequence(spark, n, dtype="double")


@register(
    "s9_read_yearly",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def s9_read_yearly(spark, sf):
    orders = td.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("yr")
    )
    path = stage(spark, sf, "orders_by_year", orders, "csv", header="true", partition_by=["yr"])
    df = S.read_yearly(
        spark, path, fmt="csv", schema="o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE",
        pattern=r"yr=(\d{4})",
    )
    return df.select("o_orderkey", "o_orderstatus", "o_totalprice", "year")


@register(
    "s10_read_headerless_routes",
    with_(TRADE_EDGES)
    + """, named AS (SELECT n.n_name, concat(n.n_name, ', ', r.r_name) AS label
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT d.label AS dest, o.label AS origin, count(*)::BIGINT AS count
FROM trade_edges e JOIN named d ON e.dst = d.n_name JOIN named o ON e.src = o.n_name
GROUP BY 1, 2""",
)
def s10_read_headerless_routes(spark, sf):
    g = td.trade_graph(spark, sf)
    nation = td.table(spark, sf, "nation")
    region = td.table(spark, sf, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_name", F.concat_ws(", ", "n_name", "r_name").alias("label")
    )
    counts = G.edge_counts(g)
    lines = (
        counts.join(named.select(F.col("n_name").alias("dst"), F.col("label").alias("dest")), "dst")
        .join(named.select(F.col("n_name").alias("src"), F.col("label").alias("origin")), "src")
        .select(F.concat_ws(",", "dest", "origin", F.col("count").cast("string")).alias("value"))
    )
    path = stage(spark, sf, "routes_txt", lines, "text")
    return S.read_headerless_routes(spark, path)


@register(
    "s11_write_table",
    with_(TRADE_EDGES) + "SELECT src, dst, count(*)::BIGINT AS count FROM trade_edges GROUP BY src, dst",
)
def s11_write_table(spark, sf):
    counts = G.edge_counts(td.trade_graph(spark, sf))
    path = stage(spark, sf, "edge_counts_parquet", counts, "parquet", partition_by=["src"])
    return spark.read.parquet(path).select("src", "dst", "count")


@register(
    "s8_read_images",
    """SELECT vec_id, label, 8 AS width, 8 AS height, 1 AS n_channels,
  CAST(list_sum(list_transform(embedding[1:64],
    lambda v: CAST(greatest(0, least(255, floor((CAST(v AS DOUBLE) + 1.0) * 127.5))) AS BIGINT))) AS BIGINT) AS pixel_sum
FROM embeddings""",
)
def s8_read_images(spark, sf):
    """Images rendered from the embeddings (one folder per label), decoded by
    Spark's image source; label and id come back from the file path.  Each batch
    of images is listed, decoded and stored before the next, so that the
    driver never holds the list of all files."""
    from quarry.plans.staging import stage_embedding_images

    # byte i of the pixel buffer as a number (the check sums them)
    pixels = F.expr(
        "transform(sequence(1, length(image.data)), i -> CAST(conv(hex(substring(image.data, i, 1)), 16, 10) AS BIGINT))"
    )
    columns = [
        F.regexp_extract("image.origin", r"/(\d+)\.png$", 1).cast("bigint").alias("vec_id"),
        F.regexp_extract("label", r"label_(\d+)", 1).cast("int").alias("label"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("n_channels"),
        F.aggregate(pixels, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("pixel_sum"),
    ]
    tasks = 4 * spark.sparkContext.defaultParallelism  # Spark plans a task for some 32 small files
    out = stage_path(spark, f"decoded-{uuid.uuid4().hex}")
    schema = "vec_id bigint, label int, width int, height int, n_channels int, pixel_sum bigint"
    for folder in stage_embedding_images(spark, sf, td.table(spark, sf, "embeddings", spread_out=True)):
        S.write_table(S.read_images(spark, folder).select(*columns).coalesce(tasks), out, mode="append")
    return spark.read.schema(schema).parquet(out)
