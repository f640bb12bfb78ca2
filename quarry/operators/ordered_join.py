"""Equi-join with a time order (inventory J3): pairs of one key, the left before the right.

An equi-join alone meets every left with every right row of a key, and a key
that holds a third of all rows in one task.  Here the rows of a busy key are cut
into buckets of time, by quantiles of the key's own right rows.  A right row
stands in its bucket; a left row is repeated for its own and the later buckets
(as far as ``within`` reaches), so pairs of an earlier bucket never meet and a
busy key is as many tasks as it has buckets.  Only inside a bucket the order is
tested.  Keys that are not busy have one bucket and are joined as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_dir

#: Right rows of a key that share a bucket; most buckets of a key.
BUCKET_ROWS, MOST_BUCKETS = 2_000, 1_000
#: Cells that keys are hashed into, to find those that may be busy.
CELLS = 1 << 20


def time_borders(right: DataFrame, on: Sequence[str], time: str, bucket_rows: int) -> DataFrame:
    """``on`` and ``borders`` (rising starts of the second and later buckets) of the keys that need more than one.

    A busy key lies in a busy cell, and cells are counted without a shuffle of the rows; only the rows of busy cells are
    counted by key."""
    cell = F.pmod(F.xxhash64(*on), F.lit(CELLS))
    cells = right.groupBy(cell.alias("__cell")).agg(F.count(time).alias("n")).where(F.col("n") > bucket_rows).select("__cell")
    right = right.withColumn("__cell", cell).join(F.broadcast(cells), "__cell", "left_semi").drop("__cell")
    counts = right.groupBy(*on).agg(F.count(time).alias("n")).where(F.col("n") > bucket_rows)
    busy = right.join(counts, list(on), "left_semi").where(F.col(time).isNotNull())
    shares = [i / MOST_BUCKETS for i in range(1, MOST_BUCKETS)]
    cuts = busy.groupBy(*on).agg(F.percentile_approx(time, F.lit(shares), F.lit(10 * MOST_BUCKETS)).alias("cuts"), F.count("*").alias("n"))
    # of the many quantiles every step-th is taken, so that a bucket has about bucket_rows
    step = F.greatest(F.lit(1), F.floor(F.lit(MOST_BUCKETS * bucket_rows) / F.col("n"))).cast("int")
    chosen = F.filter("cuts", lambda c, i: (i + 1) % step == 0)
    return cuts.select(*on, F.array_distinct(chosen).alias("borders"))


def ordered_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
    within: float | None = None, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Inner join on ``on`` with ``left_time < right_time`` (and ``right_time <= left_time + within``).

    Times are numbers; columns other than ``on`` must have different names on the two sides.  Defined cases: null keys
    and null times match nothing; equal times match nothing; repeated rows match as often as they stand; an empty side
    gives no rows."""
    on = list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    scratch_dir(left.sparkSession)
    borders = time_borders(right, on, right_time, bucket_rows).checkpoint()
    left, right = left.where(F.col(left_time).isNotNull()), right.where(F.col(right_time).isNotNull())
    if borders.isEmpty():  # no busy key: one bucket each
        joined = left.join(right, on)
    else:
        bucket = lambda t: F.coalesce(F.size(F.filter("borders", lambda b: b <= t)), F.lit(0))
        ends = F.coalesce(F.size("borders"), F.lit(0)) if within is None else bucket(F.col(left_time) + within)
        left = left.join(borders, on, "left").withColumn("__bucket", F.explode(F.sequence(bucket(F.col(left_time)), ends)))
        right = right.join(borders, on, "left").withColumn("__bucket", bucket(F.col(right_time)))
        joined = left.drop("borders").join(right.drop("borders"), [*on, "__bucket"]).drop("__bucket")
    joined = joined.where(F.col(left_time) < F.col(right_time))
    return joined if within is None else joined.where(F.col(right_time) <= F.col(left_time) + within)
