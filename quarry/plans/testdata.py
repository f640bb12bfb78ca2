"""Inputs derived from the driver tables.

Every function reads whole tables with ``spark.read.parquet`` and returns a
lazy DataFrame (or Graph); nothing is collected.  Column pruning and filters
reach the Parquet scans because everything stays declarative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.graph import Graph

DATE_FMT = "M/d/yyyy H:mm"
#: Most rows of a partition that ``spread`` leaves or makes.
SPREAD_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str, spread_out: bool = False) -> DataFrame:
    """A driver table.  ``spread_out`` is for inputs of CPU-heavy narrow work
    (tokenising, iterative model fits); scans that feed joins or
    aggregations are left alone because those shuffle anyway."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_out else df


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """Spread an under-partitioned scan over the cores.

    A large file scans as one task per row group at most, which would run every
    later narrow step (tokenising, exploding, model passes) in few tasks, each
    as large as the table makes it.  When the scan has fewer partitions than
    the cluster's default parallelism, or than one for every ``rows`` rows,
    rows are dealt round-robin into that many partitions, so a task's share of
    a cached training set does not grow with the table.  Inputs made of enough
    files are left untouched; filters and column pruning still reach the scan
    below the repartition.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    target = cores * max(1, -(-df.count() // (rows * cores)))  # whole rounds of tasks
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def trade_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Nations as vertices; one edge per line item from the customer's nation
    to the supplier's nation.  ``item`` is the part, ``start_date`` the order
    date and ``end_date`` the ship date, both as ``M/d/yyyy H:mm`` text (the
    shape of a trip table)."""
    nation = table(spark, sf_dir, "nation")
    vertices = nation.select(F.col("n_name").alias("id"), "n_nationkey", "n_regionkey")
    cust = table(spark, sf_dir, "customer").join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("src")), "c_nationkey"
    ).select(F.col("c_custkey").alias("o_custkey"), "src")
    supp = table(spark, sf_dir, "supplier").join(
        nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("dst")), "s_nationkey"
    ).select(F.col("s_suppkey").alias("l_suppkey"), "dst")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(cust, "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    edges = lines.join(orders, "o_orderkey").join(supp, "l_suppkey").select(
        "src",
        "dst",
        F.col("o_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("item"),
        F.date_format("o_orderdate", DATE_FMT).alias("start_date"),
        F.date_format("l_shipdate", DATE_FMT).alias("end_date"),
    )
    return Graph(vertices, edges)


def part_chain_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Parts as vertices; an edge from each line item's part to the part on the
    next line of the same order.  Lines are ordered by all their columns so
    the edge multiset is deterministic.  The next line is found through
    global positions (``lead_within``), so even an order holding a third of
    all lines is spread over many tasks."""
    from quarry.operators.shaping import lead_within

    part = table(spark, sf_dir, "part")
    vertices = part.select(F.col("p_partkey").alias("id"), "p_name", "p_size")
    order_cols = [
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *order_cols)
    edges = (
        lead_within(lines, ["l_orderkey"], order_cols, "l_partkey", "dst")
        .select(
            F.col("l_partkey").alias("src"),
            "dst",
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line"),
        )
        .where(F.col("dst").isNotNull())
    )
    return Graph(vertices, edges)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId int, movieId int, rating float): customer x part, rating is the
    mean of ``least(ceil(quantity / 10), 5)`` over that pair's line items."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity"
    )
    return (
        lines.join(orders, "o_orderkey")
        .groupBy(F.col("o_custkey").cast("int").alias("userId"), F.col("l_partkey").cast("int").alias("movieId"))
        .agg(F.avg(F.least(F.ceil(F.col("l_quantity") / 10), F.lit(5)).cast("double")).cast("float").alias("rating"))
    )


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` with a ``features`` vector column (64 doubles)."""
    from pyspark.ml.functions import array_to_vector

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", array_to_vector("embedding").alias("features")
    )


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a binary label (returned = 'R') and four numeric columns."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
    )
