"""Relational shaping (inventory P1-P14, A1-A7, O1-O5, Q1-Q2).

Most of these are one DataFrame call; the helpers here add what the plain
call lacks at scale: deterministic splits (hash of a key, not a random
number), exact ranks and quantiles without a single-partition window
(range partitioning + per-partition running sums + offsets of a table that
has one row per partition), and top-k per group through a window that
Catalyst turns into a group limit before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from quarry.functions.scalar import hash_share
from quarry.session import scratch_dir

# ----------------------------------------------------------------- projections


def select_expr(df: DataFrame, *exprs: str) -> DataFrame:
    """SQL-text projections with aliases and ``*``."""
    return df.selectExpr(*exprs)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns."""
    return df.withColumnsRenamed(mapping)


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column, e.g. a class label."""
    return df.withColumn(name, F.lit(value))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names resolve case-insensitively like the analyser (P5)."""
    lower = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every listed column is non-null."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def with_token(df: DataFrame, tokens_col: str, token: str) -> DataFrame:
    """Rows whose token array contains ``token``."""
    return df.where(F.array_contains(F.col(tokens_col), token))


def explode_structs(df: DataFrame, keep: Sequence[str], array_col: str) -> DataFrame:
    """One row per struct of an array-of-struct column, fields as columns."""
    return df.select(*keep, F.inline(F.col(array_col)))


# ----------------------------------------------------------------- splits


def split_column(df: DataFrame, weights: Sequence[float], key: str | Column, seed: int = 0, name: str = "split") -> DataFrame:
    """Add the split index (0..len(weights)-1) chosen by a hash of ``key``.

    ``hash_share(key, seed)`` (a percentage) is held against the cumulative
    weights, so the assignment depends only on the key: it survives
    repartitioning and recomputation and can be recomputed in SQL.  Weights
    may be any fraction.
    """
    total = float(sum(weights))
    share = hash_share(key, seed)
    cum, expr = 0.0, None
    for i, w in enumerate(weights[:-1]):
        cum += 100.0 * w / total
        cond = share < F.lit(round(cum, 9))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    last = F.lit(len(weights) - 1)
    return df.withColumn(name, last if expr is None else expr.otherwise(last))


def split_rows(df: DataFrame, weights: Sequence[float], key: str | Column, seed: int = 0) -> list[DataFrame]:
    """Train/test style split into ``len(weights)`` DataFrames (disjoint, complete)."""
    tagged = split_column(df, weights, key, seed, "__split")
    return [tagged.where(F.col("__split") == i).drop("__split") for i in range(len(weights))]


def stratified_split(df: DataFrame, weights: Sequence[float], key: str, strata: str, seed: int = 0) -> list[DataFrame]:
    """Split within each stratum (D1): the hash is salted with the stratum
    value so every class is split by the same fractions."""
    salted = F.concat_ws("|", F.col(strata).cast("string"), F.col(key).cast("string"))
    return split_rows(df, weights, salted, seed)


# ----------------------------------------------------------------- ranks, quantiles


def global_cumsums(df: DataFrame, order: Sequence[Column | str], weights: dict[str, Column | str]) -> DataFrame:
    """Running totals (one output column per entry of ``weights``) in the
    total order ``order`` without a single-partition window.

    Rows are range-partitioned on ``order`` and checkpointed (so partition
    ids are fixed), summed inside each partition, and shifted by the totals
    of earlier partitions (a table with one row per partition, broadcast).
    ``order`` must be a total order for the result to be deterministic.
    """
    spark = df.sparkSession
    scratch_dir(spark)
    nparts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    tmp = {name: f"__w_{name}" for name in weights}
    staged = df
    for name, w in weights.items():
        staged = staged.withColumn(tmp[name], F.col(w) if isinstance(w, str) else w)
    ranged = staged.repartitionByRange(nparts, *order_cols).withColumn("__pid", F.spark_partition_id()).checkpoint()
    running = Window.partitionBy("__pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged
    for name in weights:
        local = local.withColumn(f"__l_{name}", F.sum(tmp[name]).over(running))
    totals = ranged.groupBy("__pid").agg(*[F.sum(tmp[n]).alias(f"__t_{n}") for n in weights])
    offsets = totals.select(
        "__pid", *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in weights]
    )
    out = local.join(F.broadcast(offsets), "__pid")
    for name in weights:
        out = out.withColumn(name, F.col(f"__o_{name}") + F.col(f"__l_{name}"))
    drop = ["__pid"] + [c for n in weights for c in (tmp[n], f"__l_{n}", f"__o_{n}")]
    return out.drop(*drop)


def global_cumsum(df: DataFrame, order: Sequence[Column | str], weight: Column | str, name: str = "cum") -> DataFrame:
    """Running total of one weight in the total order ``order`` (see ``global_cumsums``)."""
    return global_cumsums(df, order, {name: weight})


def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "index") -> DataFrame:
    """0-based position of each row in the total order ``order`` (distributed).

    One range exchange: rows are sorted in their range and numbered by partition and place; a place is shifted by the
    rows of earlier partitions (a table with one row per partition, broadcast)."""
    spark = df.sparkSession
    scratch_dir(spark)
    nparts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(nparts, *order_cols).sortWithinPartitions(*order_cols)
    numbered = ranged.withColumn("__row", F.monotonically_increasing_id()).checkpoint()  # partition << 33 | place
    numbered = numbered.withColumn("__pid", F.shiftright("__row", 33))
    sizes = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    placed = numbered.join(F.broadcast(offsets), "__pid")
    return placed.withColumn(name, F.col("__row") - F.shiftleft("__pid", 33) + F.col("__o")).drop("__pid", "__row", "__o")


#: Ranges of values per shuffle partition: few ids hash unevenly, more of them even out.
RANGES = 4


def _in_ranges(df: DataFrame, col: str) -> DataFrame:
    """``df``, checkpointed, with ``__rid``: the number of the row's range of the numeric column ``col``.

    The bounds are quantiles of a mergeable summary.  Nulls come before all numbers and NaN after them, as Spark
    sorts them."""
    spark = df.sparkSession
    scratch_dir(spark)
    held = df.checkpoint()
    ranges = RANGES * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    number = F.col(col).cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    found = held.agg(F.percentile_approx(finite, [i / ranges for i in range(1, ranges)], 10 * ranges).alias("q")).first()["q"]
    bounds = sorted(set(found or [])) or [0.0]
    splits = [float("-inf"), *bounds, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="__x", outputCol="__b", handleInvalid="keep").transform(held.withColumn("__x", number))
    return bucketed.withColumn("__rid", F.when(F.col("__x").isNull(), -1).otherwise(F.col("__b").cast("int"))).drop("__x", "__b")


def _range_offsets(ranged: DataFrame, weights: dict[str, str], descending: bool) -> DataFrame:
    """Per range: the totals of its weights (``__t_*``) and those of the ranges before it (``__o_*``)."""
    way = F.col("__rid").desc() if descending else F.col("__rid").asc()
    before = Window.orderBy(way).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__rid").agg(*[F.sum(w).alias(f"__t_{n}") for n, w in weights.items()])
    return totals.select("*", *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in weights])


def _range_sums(ranged: DataFrame, offsets: DataFrame, col: str, weights: dict[str, str], descending: bool) -> DataFrame:
    """Running totals inside the ranges, shifted by the ranges before them: one exchange, on the range."""
    way = F.col(col).desc() if descending else F.col(col).asc()
    running = Window.partitionBy("__rid").orderBy(way).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(w).over(running).alias(f"__l_{n}") for n, w in weights.items()])
    out = local.join(F.broadcast(offsets), "__rid")
    out = out.withColumns({n: F.col(f"__o_{n}") + F.col(f"__l_{n}") for n in weights})
    return out.drop("__rid", *[f"__{k}_{n}" for n in weights for k in "lto"])


def sums_by_value(df: DataFrame, col: str, weights: dict[str, str], descending: bool = False) -> DataFrame:
    """Running totals (one output column per entry of ``weights``) in the order of the numeric column ``col``, whose
    values differ from row to row, with one exchange of the rows: ranges of values are numbered first, so that the
    window runs in the layout that brings a range together."""
    ranged = _in_ranges(df, col)
    return _range_sums(ranged, _range_offsets(ranged, weights, descending), col, weights, descending)


def lead_within(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str = "next"
) -> DataFrame:
    """``lead(value)`` over each group in ``order``, without putting a group in one task.

    Rows are range-partitioned on ``(group..., order...)`` (the later columns
    split even a group holding a third of all rows) and checkpointed, so that
    partition ids are fixed.  Each row looks at the next one of its partition;
    the last one looks at the first row of the partition after it, from a table
    with one row per partition.  Rows identical in every sort column are
    interchangeable; give a total order for exact reproducibility.
    """
    spark = df.sparkSession
    scratch_dir(spark)
    cols = list(group) + [c for c in order if c not in group]
    nparts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(nparts, *cols).withColumn("__pid", F.spark_partition_id()).checkpoint()
    seen = F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], F.col(value).alias("value"))
    local = ranged.withColumn("__next", F.lead(seen).over(Window.partitionBy("__pid").orderBy(*cols)))
    heads = ranged.groupBy("__pid").agg(F.min(F.struct(*cols, seen.alias("__seen")))["__seen"].alias("__head"))
    heads = heads.select("__pid", F.lead("__head").over(Window.orderBy("__pid")).alias("__head"))  # at most nparts rows
    joined = local.join(F.broadcast(heads), "__pid", "left")
    nxt = F.coalesce("__next", "__head")
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(nxt[f"g{i}"])
    return joined.withColumn(name, F.when(nxt.isNotNull() & same, nxt["value"])).drop("__pid", "__next", "__head")


def _value_counts(df: DataFrame, col: str) -> DataFrame:
    """Distinct values and ``cnt``: a value that holds a third of all rows is one row from here on."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def value_ranks(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` with ``cnt`` and cumulative count ``cum`` (ascending)."""
    counts = _value_counts(df, col)
    if isinstance(df.schema[col].dataType, NumericType):
        return sums_by_value(counts, col, {"cum": "cnt"})
    return global_cumsum(counts, [F.col(col).asc()], "cnt", "cum")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles ``(p, value)``: the smallest value whose cumulative
    count reaches ``max(1, ceil(p * N))`` (the nearest-rank definition, equal
    to Spark's approxQuantile with relativeError 0).

    Of a numeric column only the ranges that hold a wanted rank are sorted: their totals, one row per range, tell which."""
    if isinstance(df.schema[col].dataType, NumericType):
        ranged = _in_ranges(_value_counts(df, col), col)
        offsets = _range_offsets(ranged, {"cum": "cnt"}, False)
        held = offsets.select("__rid", "__o_cum", "__t_cum").collect()  # one row per range
        total = sum(r["__t_cum"] for r in held)
        wanted = [_rank(p, total) for p in probs]
        some = [r["__rid"] for r in held if any(r["__o_cum"] < w <= r["__o_cum"] + r["__t_cum"] for w in wanted)]
        ranks = _range_sums(ranged.where(F.col("__rid").isin(some)), offsets, col, {"cum": "cnt"}, False)
    else:
        ranks = value_ranks(df, col)
        total = ranks.agg(F.max("cum").alias("n")).first()["n"] or 0
    picks = [F.min(F.when(F.col("cum") >= _rank(p, total), F.col(col))).alias(f"q{i}") for i, p in enumerate(probs)]
    stack = ", ".join(f"{float(p)!r}D, q{i}" for i, p in enumerate(probs))
    return ranks.agg(*picks).selectExpr(f"stack({len(probs)}, {stack}) AS (p, value)")


def _rank(p: float, total: int) -> int:
    return max(1, math.ceil(p * total - 1e-12))


def approx_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], rank_error: float = 0.001, by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles ``(by..., p, value, n)`` from a mergeable summary in one pass, per group of ``by``.

    The rank of every value among the group's ``n`` is within ``rank_error * n`` of ``p * n``.  Partitions summarise
    their rows and the summaries merge, so a group that holds a third of all rows is a few summaries; a summary's size
    follows ``1 / rank_error``.  Nulls are left out; a group of nulls has value null and n 0; an empty table gives no
    groups."""
    if not 0 < rank_error < 1:
        raise ValueError("0 < rank_error < 1")
    probs = [float(p) for p in probs]
    found = F.percentile_approx(F.col(col), F.array(*[F.lit(p) for p in probs]), F.lit(math.ceil(1 / rank_error)))
    grouped = df.groupBy(*by).agg(found.alias("__q"), F.count(col).alias("n"))
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.get("__q", F.lit(i)).alias("value")) for i, p in enumerate(probs)]))
    return grouped.select(*by, pairs.alias("__r"), "n").select(*by, "__r.p", "__r.value", "n")


def column_stats(df: DataFrame, vector_col: str) -> DataFrame:
    """Per position of a vector/array column: min, max, max |x|, mean, sample std."""
    from pyspark.ml.functions import vector_to_array

    arr = df.select(vector_to_array(F.col(vector_col)).alias("__a")) if _is_vector(df, vector_col) else df.select(
        F.col(vector_col).cast("array<double>").alias("__a")
    )
    ex = arr.select(F.posexplode("__a").alias("pos", "x"))
    return ex.groupBy("pos").agg(
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.max(F.abs("x")).alias("max_abs"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
    )


def _is_vector(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "vector" or "Vector" in type(df.schema[col].dataType).__name__


def label_frequency(df: DataFrame, col: str) -> DataFrame:
    """``(value, count, index)``: most frequent first, ties by value as text
    ascending; ``index`` is the position in that order (A7)."""
    counts = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return global_index(counts, [F.col("count").desc(), F.col("value").asc()], "index")


# ----------------------------------------------------------------- sorts, top-k


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """Ordered limit; planned as ``TakeOrderedAndProject`` (O3)."""
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, rank_col: str = "rank") -> DataFrame:
    """At most ``k`` rows per group in ``order`` (O4).  ``row_number() <= k``
    is planned with a per-partition group limit before the shuffle, so a hot
    group ships at most k rows per input partition."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


# ----------------------------------------------------------------- cache


class cached:
    """``with cached(df) as d:`` persists for the block and unpersists after."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __enter__(self) -> DataFrame:
        return self.df.persist()

    def __exit__(self, *exc) -> None:
        self.df.unpersist()
