"""Document fingerprints: one-permutation MinHash in 4-bit slots.

The hashes of a text's five-word shingles are binned once by their first bits;
a bin keeps its least hash.  An empty bin takes the hash of the first filled
bin in its own random order of all bins (optimal densification: every filled
bin is as likely).  A slot stores the low bits of the kept hash mixed with the
slot's number.  Slots of different texts agree by chance once in 2**BITS, so
the share of equal slots is corrected for that.

All steps are DataFrame functions.  Texts are shuffled once, in ranges of
doc_id, to meet the next document.

Defined cases: null text is empty; a text without words has fingerprint zero
and is like another such text only; shorter texts are one shingle; null ids
come last; rows with one id follow each other in the order of their texts'
hash; the next document of a single row is itself; an empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved, shuffle_partitions, whole_text

#: Words in a shingle; bins (a power of two) and the bits of their number; stored bits of a slot; slots in a long.
SHINGLE, BINS, BIN_BITS, BITS, SLOTS = 5, 256, 8, 4, 16
#: Places an empty bin looks at one by one before the rest is searched at once.
LOOKS = 8
#: Ranges of doc_id per shuffle partition.
RANGES = 4


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though functions of it run for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _orders() -> tuple[list[int], list[int], list[int]]:
    """Bin b looks at bin (start + t * step) mod BINS at time t: an odd step
    reaches every bin.  Also the inverse steps, which give the time of a bin."""
    rnd = random.Random(17)
    steps = [2 * rnd.randrange(BINS // 2) + 1 for _ in range(BINS)]
    return [rnd.randrange(BINS) for _ in range(BINS)], steps, [pow(s, -1, BINS) for s in steps]


def words(text: Column) -> Column:
    """Words of a text; none for an empty one."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def shingle_hashes(text: Column) -> Column:
    """XXH64 of every shingle."""
    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", F.slice(w, i, F.lit(SHINGLE)))))
        return F.when(F.size(w) > 0, hashes).otherwise(F.array().cast("array<bigint>"))

    return _let(words(text), of)


def fingerprint(text: Column) -> Column:
    """Packed slots: array of BINS / SLOTS longs, zeros for a text without words."""
    mask = F.lit(BINS - 1)
    starts, steps, inverse = (F.lit(x) for x in _orders())
    every = F.sequence(F.lit(0), F.lit(BINS - 1))

    def bin_of(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - BIN_BITS).cast("int")

    def least(hashes: Column) -> Column:  # sorted: the first of a bin is its least
        return F.filter(hashes, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(hashes, i - 1))))

    def dense(firsts: Column) -> Column:  # hash of every bin, null where it is empty
        return _let(F.map_from_arrays(F.transform(firsts, bin_of), firsts), lambda m: F.transform(every, lambda b: m[b]))

    def filled(firsts: Column, bins: Column) -> Column:
        def donor(b: Column) -> Column:
            start, step, back = F.get(starts, b), F.get(steps, b), F.get(inverse, b)
            looks = [F.get(bins, (start + step * t).bitwiseAND(mask)) for t in range(LOOKS)]
            times = F.transform(
                firsts, lambda f: ((bin_of(f) - start) * back).bitwiseAND(mask) * BINS + bin_of(f))
            return F.coalesce(F.get(bins, b), *looks, F.get(bins, F.array_min(times).bitwiseAND(mask)))

        return F.transform(every, lambda b: F.xxhash64(donor(b), b).bitwiseAND(F.lit((1 << BITS) - 1)))

    def packed(slots: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // SLOTS - 1)), lambda j: F.aggregate(
            F.slice(slots, j * SLOTS + 1, F.lit(SLOTS)), F.lit(0).cast("bigint"),
            lambda acc, s: F.shiftleft(acc, BITS).bitwiseOR(s)))

    whole = _let(F.sort_array(shingle_hashes(text)), lambda h: F.when(
        F.size(h) > 0,
        _let(least(h), lambda f: _let(dense(f), lambda b: _let(filled(f, b), packed))),
    ))
    return F.coalesce(whole, F.array_repeat(F.lit(0).cast("bigint"), BINS // SLOTS))


def as_hex(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda p: F.lpad(F.lower(F.hex(p)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles of two fingerprints, 0 to 1."""
    low = F.lit(int("1" * (64 // BITS), 16))  # the lowest bit of every slot

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        any_bit = d
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(d, k))
        return F.bit_count(any_bit.bitwiseAND(low))

    odd = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, n: acc + n)
    chance = 1 / (1 << BITS)
    corrected = ((BINS - odd) / BINS - chance) / (1 - chance)
    empty = F.array_repeat(F.lit(0).cast("bigint"), BINS // SLOTS)
    return F.when(a == b, 1.0).when((a == empty) | (b == empty), 0.0).otherwise(F.greatest(corrected, F.lit(0.0)))


def _in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text, ``tie`` and ``range``: ranges of falling doc_id, null ids last."""
    n = RANGES * shuffle_partitions(docs.sparkSession)
    shares = [k / n for k in range(1, n)]
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, max(10_000, 20 * n)).alias("b")).first()
    bounds = sorted(set(found["b"] or []), reverse=True)
    step = max(1, round(len(bounds) ** 0.5))  # two short searches in place of a long one
    tops = bounds[step - 1::step]
    doc = F.col("doc_id").cast("long")

    def above(list_: Column) -> Column:
        return F.size(F.filter(list_, lambda b: b > doc))

    if bounds:
        every = F.lit(bounds)
        sure = above(F.lit(tops)) * step if tops else F.lit(0)
        at = _let(sure, lambda s: s + above(F.slice(every, s + 1, F.lit(step))))
    else:
        at = F.lit(0)
    rows = docs.select(doc.alias("doc_id"), whole_text().alias("text"))
    at = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(at)
    return rows.select("doc_id", "text", F.xxhash64("text").alias("tie"), at.cast("int").alias("range"))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (range, place, guest, doc_id, text, next_text) in falling doc_id.
    Every range ends with a guest, the first row of the range after it."""
    rows = _in_ranges(docs)
    order = F.struct(F.col("doc_id").isNull().alias("null"), F.bitwise_not("doc_id").alias("down"), F.col("tie"))
    # one narrow row per range
    heads = saved(rows.groupBy("range").agg(F.min(order).alias("head")), "range-heads")
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(whole))
    heads = heads.select(F.col("range").alias("of"), "head", before.alias("before"))
    first = rows.join(F.broadcast(heads), (rows["range"] == heads["of"]) & order.eqNullSafe(heads["head"]))
    guests = first.groupBy("before").agg(F.first(F.struct("doc_id", "text", "tie")).alias("row"))
    guests = guests.select("row.doc_id", "row.text", "row.tie", F.col("before").alias("range"), F.lit(1).alias("guest"))
    every = rows.withColumn("guest", F.lit(0)).unionByName(saved(guests, "range-guests"))
    every = every.repartition(RANGES * shuffle_partitions(docs.sparkSession), "range")
    falling = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "tie")
    return every.select(
        "range", F.row_number().over(falling).alias("place"), "guest", "doc_id", "text",
        F.lead("text").over(falling).alias("next_text"),
    )


def compare(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text is the text with its last floor(n / 2) code points replaced
    by the first as many (or all) of the next document's."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = with_next(docs).select(
        "range", "place", "guest", "doc_id", "text", n.cast("long").alias("n_chars"),
        F.when(F.col("guest") == 0, edited).alias("edited"),
    )
    rows = rows.select(
        "range", "place", "guest", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("own"),
        F.when(F.col("guest") == 0, fingerprint(F.col("edited"))).alias("changed"),
    )
    following = F.lead("own").over(Window.partitionBy("range").orderBy("place"))
    rows = rows.withColumn("following", following).where(F.col("guest") == 0)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("own")).alias("fingerprint"),
        as_hex(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
