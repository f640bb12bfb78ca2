"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the tokens of its source up to and
including it, in a shuffled order, over the source's target.  Documents are
served in order of that time until the total budget is spent, so all sources
reach their targets together.  A source may be passed over ``max_repeats``
times; pass ``e`` continues where pass ``e - 1`` ended.

All steps are DataFrame operations.  Running sums never put a source into one
task: a source is cut into ``SLICES`` ranges of its shuffle key, ranges are
pre-aggregated, and only rows of one range meet in a window.  The place where
the budget ends is found from sums of ever finer ranges of the virtual time;
the driver sees the bounds only.

Defined cases: a null text has no words; a null source is a source, last in
order; rows that share a doc_id are taken or left together; documents without
words take nothing; an empty table gives an empty plan.  Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import fresh, saved, shuffle_key, small, whole_text, word_count

#: Weights of the sources in order, repeating; the share of all words to hand out; times a source may be used.
WEIGHTS, SHARE, MAX_REPEATS, SEED = (3, 1, 2), 1.5, 2, 11
#: Ranges of a source's shuffle key. Virtual time is cut into 2**10 coarse ranges a unit, each into 2**10 fine ones;
#: times from 64 on share a range (the budget ends near 1).
SLICES, RANGE_BITS, LATEST = 512, 10, 64


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """One narrow row per document: source (``src_null``, ``src``), size and shuffle key."""
    return docs.select(
        "doc_id",
        F.col("source").isNull().alias("src_null"),
        F.coalesce(F.col("source"), F.lit("")).alias("src"),
        word_count(whole_text()).alias("size"),
        shuffle_key(F.col("doc_id"), seed).alias("rnd"),
    )


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, max_repeats: int) -> DataFrame:
    """One row per source: its size and target.  The budget, ``share`` of all
    words, is dealt by weight; no source gets more than ``max_repeats`` times
    its size, and what is left over is dealt again among the others.

    A source is full if the level at which it fills, cap / weight, can be paid
    for: the caps of those that fill before it plus that level for all others.
    The windows run over one row per source.
    """
    order = Window.orderBy("src_null", "src")
    every = Window.orderBy("fill", "src_null", "src")
    before = every.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = every.rowsBetween(1, Window.unboundedFollowing)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    at = (F.row_number().over(order) - 1) % len(weights)
    per = sized.groupBy("src_null", "src").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(order)).withColumn("w", F.get(cycle, at))
    per = per.withColumn("cap", F.col("source_size") * max_repeats).withColumn("fill", F.col("cap") / F.col("w"))
    per = per.withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
    paid, rest = F.sum("cap").over(before), F.coalesce(F.sum("w").over(after), F.lit(0))
    per = per.withColumn("full", paid + F.col("fill") * rest <= F.col("budget"))
    full = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)
    level = F.try_divide(F.col("budget") - full, open_w)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level * F.col("w"))
    return per.select("src_null", "src", "rank", "source_size", "budget", target.alias("target"))


def finish_times(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_repeats=MAX_REPEATS, seed=SEED) -> DataFrame:
    """Per document: size, source_size, target and the running size ``upto`` in its source."""
    sized = saved(_sized(docs, seed), "mix-sized")
    targets = small(source_targets(sized, weights, share, max_repeats), "mix-targets")
    sized = sized.withColumn("slice", F.shiftright("rnd", 60 - SLICES.bit_length() + 1))
    key = ["src_null", "src", "slice"]
    slices = sized.groupBy(*key).agg(F.sum("size").alias("in_slice"))
    so_far = Window.partitionBy("src_null", "src").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("start", F.coalesce(F.sum("in_slice").over(so_far), F.lit(0))).drop("in_slice")
    inside = Window.partitionBy(*key).orderBy("rnd", "doc_id")  # rows with one id are peers: they finish together
    upto = F.sum("size").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        sized.join(slices, key)
        .withColumn("upto", F.col("start") + upto)
        .join(targets, ["src_null", "src"])
        .drop("start", "slice")
    )


def _time(e: int) -> Column:
    """Virtual finish time of a document in pass ``e``."""
    done = F.col("source_size") * e + F.col("upto")
    return F.when(F.col("target") > 0, done / F.col("target")).otherwise(F.lit(0.0))


def _end(times: DataFrame, max_repeats: int) -> tuple[float, int]:
    """Last (virtual time, source rank) that the budget covers.

    Sums per range of virtual time find the range where the budget ends, first
    among coarse ranges, then among the fine ones of that range; a window then
    looks at the rows of one fine range.
    """
    copies = times.select(
        "size", "budget", F.col("rank").cast("long").alias("rank"),
        F.explode(F.array(*[_time(e) for e in range(max_repeats)])).alias("time"),
    )
    fine = F.floor(F.least("time", F.lit(float(LATEST))) * float(1 << 2 * RANGE_BITS))  # a power of two: exact
    copies = copies.withColumn("fine", fine).withColumn("coarse", F.shiftright("fine", RANGE_BITS))
    spent = 0
    for level in ("coarse", "fine"):
        sums = copies.groupBy(level).agg(F.sum("size").alias("n"), F.max("budget").alias("budget"))
        upto = F.sum("n").over(Window.orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        at = sums.withColumn("upto", upto + spent).where(_over(F.col("upto"))).orderBy(level).first()
        if at is None:  # the budget covers every copy
            return float("inf"), 0
        spent = at["upto"] - at["n"]
        copies = copies.where(F.col(level) == at[level])
    peers = Window.orderBy("time", "rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = copies.withColumn("upto", F.sum("size").over(peers) + spent).where(~_over(F.col("upto")))
    got = fits.agg(F.max(F.struct("time", "rank")).alias("end")).first()["end"]
    return (got["time"], got["rank"]) if got is not None else (at["fine"] / float(1 << 2 * RANGE_BITS), -1)


def _over(upto: Column) -> Column:
    """Past the budget, but for rounding."""
    return upto > F.col("budget") * (1 + 1e-12) + 1e-6


def plan(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_repeats=MAX_REPEATS, seed=SEED) -> DataFrame:
    """One row per document: doc_id, src_null, src, rnd, size, source_size,
    target, and ``passes``, per pass whether the mix takes the document."""
    times = saved(finish_times(docs, weights, share, max_repeats, seed), "mix-times")
    time, rank = _end(times, max_repeats)
    taken = [(_time(e) < time) | ((_time(e) == time) & (F.col("rank") <= rank)) for e in range(max_repeats)]
    return times.select(
        "doc_id", "src_null", "src", "rnd", "size", "source_size", "target", F.array(*taken).alias("passes")
    )


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_repeats=MAX_REPEATS, seed=SEED) -> DataFrame:
    """The mixed documents: the columns of ``docs``, one row per copy taken.

    What a pass takes of a source is a prefix of its shuffled order, so a
    table with the last key of each source and pass decides for every row,
    and the texts are not shuffled.
    """
    planned = plan(docs, weights, share, max_repeats, seed)
    key = F.struct(F.col("rnd"), F.col("doc_id"))
    cuts = planned.groupBy("src_null", "src").agg(
        F.array(*[F.max(F.when(F.get("passes", F.lit(e)), key)) for e in range(max_repeats)]).alias("cuts")
    )
    names = {c: fresh(f"_mix_{c}", docs.columns) for c in ("src_null", "src", "cuts")}
    cuts = small(cuts.select(*[F.col(c).alias(n) for c, n in names.items()]), "mix-cuts")
    own = F.struct(shuffle_key(F.col("doc_id"), seed).alias("rnd"), F.col("doc_id"))
    copies = F.size(F.filter(F.col(names["cuts"]), lambda cut: cut.isNotNull() & (own <= cut)))
    rows = docs.withColumns(
        {names["src_null"]: F.col("source").isNull(), names["src"]: F.coalesce(F.col("source"), F.lit(""))}
    ).join(cuts, [names["src_null"], names["src"]])
    copy = fresh("_mix_copy", docs.columns)
    rows = rows.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies)))
    return rows.select(*docs.columns)
