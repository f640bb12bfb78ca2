"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are encoded and closed with an end token; only documents longer than
a sequence are cut, into full pieces, the first being the shorter one.  For
packing, pieces of one length are alike, so a packing is a table of patterns
(lengths that share a sequence) with a number of copies each, and the problem
is the number of pieces of every length: at most one row per length, whatever
the corpus.

Islands are rows of a DataFrame, each evolved by a task of its own.  A child
takes whole well-filled bins of one parent, then the bins of the other as far
as pieces are left for them (bins with duplicates go), and displaced pieces are
placed best-fit, longest first.  After each epoch the best packing of an island
moves to the next island.  The best packing of all is then dealt to the pieces:
a piece's number among those of its length gives its bin and offset.

Defined cases: null text is empty (the end token alone); repeated rows are
packed each; an empty table gives no piece; extra columns are not read.
"""

from __future__ import annotations

import pickle
import random
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.bpe import encoder
from quarry.llm.common import lean, saved, whole_text

#: Tokens of a sequence; id that ends a document.
LENGTH, END_ID = 1024, 2
#: Islands, packings on each, epochs, children per epoch; a bin this full is handed on whole.
ISLANDS, POPULATION, EPOCHS, CHILDREN, WELL_FILLED = 6, 6, 3, 12, 0.998
#: Ranges in which the pieces of one length are numbered apart; texts encoded at once.
RANGES, TEXTS = 256, 128

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

Packing = list[tuple[tuple[int, ...], int]]


def encode_pieces(docs: DataFrame, locate: Callable[[], str], length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(locate()), end_id.to_bytes(4, "little")
        for batch in batches:
            for k in range(0, len(batch), TEXTS):
                some, out = batch.slice(k, TEXTS), []
                for doc, ids in zip(some.column("doc_id").to_pylist(), own.ids(some.column("text").to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    at, size = 0, (n - 1) % length + 1
                    for piece in range(-(-n // length)):
                        out.append((doc, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)])))
                        at, size = at + size, length
                cols = list(zip(*out)) or [()] * 5
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        own.rest()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(lean(run), PIECES)


def best_fit(bins: Packing, left: dict[int, int], length: int) -> Packing:
    """Put the pieces of ``left`` (length -> number) into ``bins``, longest
    first, each into the bin with the least room that holds it; alike bins and
    alike pieces are handled together."""
    room: list[dict[tuple[int, ...], int]] = [{} for _ in range(length + 1)]
    open_rooms = 0  # bit r: some bin has room r
    for pattern, n in bins:
        r = length - sum(pattern)
        room[r][pattern] = room[r].get(pattern, 0) + n
        open_rooms |= 1 << r

    def put(pattern: tuple[int, ...], r: int, n: int) -> None:
        nonlocal open_rooms
        room[r][pattern] = room[r].get(pattern, 0) + n
        open_rooms |= 1 << r

    for size in sorted(left, reverse=True):
        n = left[size]
        while n > 0:
            fit = open_rooms >> size
            if not fit:
                most = length // size
                if n >= most:
                    put((size,) * most, length - size * most, n // most)
                if n % most:
                    put((size,) * (n % most), length - size * (n % most), 1)
                break
            r = size + (fit & -fit).bit_length() - 1
            pattern, copies = room[r].popitem()
            used = min(copies, n)
            if used < copies:
                room[r][pattern] = copies - used
            if not room[r]:
                open_rooms &= ~(1 << r)
            put(tuple(sorted(pattern + (size,), reverse=True)), r - size, used)
            n -= used
    return [(p, n) for patterns in room for p, n in patterns.items() if n]


def fitness(packing: Packing, length: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller ones (less is better for both numbers)."""
    return sum(n for _, n in packing), -sum(n * (sum(p) / length) ** 2 for p, n in packing)


def keep_bins(packing: Packing, left: dict[int, int]) -> Packing:
    """As many bins of ``packing`` as the pieces in ``left`` allow; takes them out of ``left``."""
    kept = []
    for pattern, n in packing:
        need: dict[int, int] = {}
        for size in pattern:
            need[size] = need.get(size, 0) + 1
        n = min(n, *(left.get(size, 0) // k for size, k in need.items()))
        if n > 0:
            for size, k in need.items():
                left[size] -= k * n
            kept.append((pattern, n))
    return kept


def crossover(mother: Packing, father: Packing, counts: dict[int, int], length: int, rnd: random.Random) -> Packing:
    """Whole well-filled bins of the father, then what of the mother's bins they leave, then the displaced pieces."""
    good = [b for b in father if sum(b[0]) >= WELL_FILLED * length]
    good = [(p, n if rnd.random() < 0.5 else rnd.randint(1, n)) for p, n in good if rnd.random() < 0.6]
    left = dict(counts)
    kept = keep_bins(good, left)
    others = sorted(mother, key=lambda b: (-sum(b[0]) if rnd.random() < 0.95 else 0))
    kept += keep_bins(others, left)
    # also open the emptiest bins again, so that their pieces can move
    kept.sort(key=lambda b: sum(b[0]))
    opened = rnd.randint(0, max(1, len(kept) // 20))
    for pattern, n in kept[:opened]:
        for size in pattern:
            left[size] += n
    return best_fit(kept[opened:], {s: n for s, n in left.items() if n}, length)


def founder(counts: dict[int, int], length: int, rnd: random.Random, plain: bool) -> Packing:
    """Best fit, longest first; but for the plain one, after a random part of the pieces."""
    if plain:
        return best_fit([], counts, length)
    early = {s: rnd.randint(0, n) for s, n in counts.items() if rnd.random() < 0.5}
    bins = best_fit([], {s: n for s, n in early.items() if n}, length)
    return best_fit(bins, {s: n - early.get(s, 0) for s, n in counts.items() if n > early.get(s, 0)}, length)


def apart(people: DataFrame) -> DataFrame:
    """``people`` with a partition per island, so that islands evolve side by side: a given number of range partitions
    is not coalesced, and as many distinct islands as partitions part evenly."""
    return people.repartitionByRange(ISLANDS, "island")


def evolve(spark: SparkSession, counts: dict[int, int], length: int = LENGTH, seed: int = 5) -> Packing:
    """The best packing that the islands find for ``counts`` (length -> number of pieces)."""
    schema = "island int, packing binary, bins double, fill double"
    least = -(-sum(s * n for s, n in counts.items()) // length)

    def epoch(number: int):
        def run(key, rows):
            import pandas as pd

            island = int(key[0])
            rnd = random.Random(f"{seed}/{number}/{island}")
            rated = lambda packing: fitness(packing, length)
            people = sorted((pickle.loads(p) for p in rows["packing"].dropna()), key=lambda p: (rated(p), p))
            while len(people) < POPULATION:
                people.append(founder(counts, length, rnd, island == 0 and not people))
            for _ in range(CHILDREN):
                people.sort(key=rated)
                if rated(people[0])[0] == least:
                    break
                mother, father = rnd.choice(people[: len(people) // 2 + 1]), rnd.choice(people)
                people.append(crossover(mother, father, counts, length, rnd))
                people = sorted(people, key=rated)[:POPULATION]
            people.sort(key=rated)
            moved = [(island, pickle.dumps(p), *map(float, rated(p))) for p in people]
            moved.append(((island + 1) % ISLANDS, *moved[0][1:]))  # the elite moves on
            return pd.DataFrame(moved, columns=["island", "packing", "bins", "fill"])

        return run

    people = spark.range(ISLANDS).select(F.col("id").cast("int").alias("island"), F.lit(None).cast("binary").alias("packing"))
    for number in range(EPOCHS):
        people = saved(apart(people).groupBy("island").applyInPandas(epoch(number), schema), "island")
    best = people.orderBy("bins", "fill", "packing").first()
    return pickle.loads(best["packing"])


def numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``number``: from 0 among the pieces of the same length.
    A length is numbered in RANGES ranges of a hash, so a common one is split."""
    key = ["length", "range"]
    pieces = pieces.withColumn("range", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANGES)).cast("int"))
    sizes = pieces.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy(*key).orderBy("doc_id", "piece", "start", "ids_crc32")
    rows = pieces.join(sizes, key).withColumn("number", F.col("base") + F.row_number().over(inside) - 1)
    return rows.drop("base", "range")


def pack(docs: DataFrame, locate: Callable[[], str], length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces with sequence_id and offset."""
    pieces = saved(encode_pieces(docs, locate, length, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    packing = sorted(evolve(docs.sparkSession, counts, length), reverse=True) if counts else []
    # places of each length in order: the pieces lo, lo + 1 ... of that length go to copies 0, 1 ... of a pattern
    used: dict[int, int] = {}
    places, first = [], 0
    for pattern, n in packing:
        at = 0
        for size in pattern:
            lo = used.get(size, 0)
            places.append(((size << 40) + lo, first - lo, at))
            used[size] = lo + n
            at += size
        first += n
    places.sort()
    los, shifts, ats = (np.array(c, np.int64) for c in (zip(*places) if places else ([], [], [])))
    out = f"{PIECES}, sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy()
            at = np.searchsorted(los, (batch.column("length").to_numpy() << 40) + number, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(shifts[at] + number), pa.array(ats[at])],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    names = [c.split()[0] for c in PIECES.split(", ")]
    return numbered(pieces).select(*names, "number").mapInArrow(lean(place), out)
