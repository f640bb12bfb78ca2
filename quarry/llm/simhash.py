"""SimHash near-dedup by tiled exact comparison.

Fingerprints of 64 bits come from hashed word shingles.  Equal fingerprints
form one class first.  Classes are dealt into tiles by the population counts
of the four 16-bit words of the fingerprint: two fingerprints that differ in r
bits have counts that differ by at most r in sum, so a tile is compared only
with tiles whose counts are within the radius, and all other tile pairs are
skipped without losing a link.  Tile pairs are compared exactly, with numpy
exclusive-or and bit counts in blocks of bounded size; a tile with many classes
is cut into parts, each compared with all it must meet.  Tasks hold one part
and one batch, and report the links of a block as a forest, not as all pairs.

Defined cases: null text is empty; texts without words have fingerprint zero
and link like any other; a null doc_id is carried along and is the component
only where no other id is; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, lean, saved, whole_text
from quarry.llm.components import components

#: Words in a shingle, bits that may differ, seed of XXH64.
SHINGLE, RADIUS, SEED = 3, 3, 42
#: Classes in a part of a tile; cells of a block compared at once; shingles whose bits are unpacked at once.
PART, BLOCK, VOTES = 2048, 1 << 21, 1 << 15
#: Words of a fingerprint and their width, for the population counts.
WORDS, WIDTH = 4, 16


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of a text: bit i is set if over half of the shingles' XXH64 have it."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white-space bytes only
    if not words:
        return 0
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], 42) for a, b in zip(starts[:n], ends[min(shingle, len(words)) - 1:])], dtype=">u8"
    )
    votes = np.zeros(64, np.int64)
    for k in range(0, n, VOTES):
        bits = np.unpackbits(hashes[k:k + VOTES].view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (to find the row again) and fp, the fingerprint as a signed long."""
    rows = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), whole_text().alias("text"))
    kept = rows.drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    return rows.mapInArrow(lean(run), kept.add("fp", "long"))


def _counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))) for i in range(WORDS)]


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of counts within the radius, one of each opposite pair, zero left out."""
    steps = [()]
    for _ in range(WORDS):
        steps = [s + (d,) for s in steps for d in range(-radius, radius + 1) if sum(map(abs, s)) + abs(d) <= radius]
    return [s for s in steps if s > (0,) * WORDS]


def _tiles(classes: DataFrame, radius: int) -> DataFrame:
    """Rows (tile, part, visitor, fp): every class once at home and as a visitor where it must be compared."""
    side = WIDTH + 1

    def number(counts: list[Column]) -> Column:
        at = F.lit(0)
        for c in counts:
            at = at * side + c
        return at.cast("int")

    counted = classes.select("fp", F.array(*_counts(F.col("fp"))).alias("c"))
    home = counted.select("fp", "c", number([F.get("c", F.lit(i)) for i in range(WORDS)]).alias("tile"))
    # at most side ** WORDS = 83,521 rows, whatever the input
    parts = saved(home.groupBy("tile").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "tiles")
    steps = _steps(radius)
    places = [F.struct(F.col("tile"), F.lit(False).alias("visitor"))]
    for step in steps:
        to = [F.get("c", F.lit(i)) + d for i, d in enumerate(step)]
        inside = F.lit(True)
        for t, d in zip(to, step):
            inside = inside & (t.between(0, WIDTH) if d else F.lit(True))
        places.append(F.struct(F.when(inside, number(to)).alias("tile"), F.lit(True).alias("visitor")))
    rows = home.select("fp", F.explode(F.array(*places)).alias("at")).select("fp", "at.tile", "at.visitor")
    rows = rows.where(F.col("tile").isNotNull()).join(F.broadcast(parts), "tile")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    part = F.when(F.col("visitor"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.sequence(F.lit(0), own))
    rows = rows.select("fp", "tile", "visitor", own.alias("own"), F.explode(part).alias("part"))
    visitor = F.col("visitor") | (F.col("part") != F.col("own"))
    return rows.select("tile", "part", visitor.alias("visitor"), "fp")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a[i]-b[i] as a forest: every node and the least node of its component here."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def _compare(own: np.ndarray, other: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links between two sets of fingerprints; same: the set with itself."""
    found = []
    rows = max(1, BLOCK // max(1, len(other)))
    for k in range(0, len(own), rows):
        near = np.bitwise_count(own[k:k + rows, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        if same:
            i, j = i[i + k < j], j[i + k < j]
        if len(i):
            found.append(_forest(own[k + i], other[j]))
    if not found:
        return own[:0], own[:0]
    return _forest(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between fingerprints at most ``radius`` bits apart, enough to connect all that are linked."""
    tiles = _tiles(classes, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own, done = None, [], False
        for batch in batches:
            tile = batch.column("tile").to_numpy().astype(np.int64) << 32 | batch.column("part").to_numpy()
            visitor = batch.column("visitor").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero((tile[1:] != tile[:-1]) | (visitor[1:] != visitor[:-1])) + 1
            out = []
            for lo, hi in zip([0, *cuts], [*cuts, len(tile)]):
                if hi == lo:
                    continue
                if tile[lo] != here:
                    if own and not done:
                        held = np.concatenate(own)
                        out.append(_compare(held, held, radius, True))
                    here, own, done = tile[lo], [], False
                if not visitor[lo]:
                    own.append(fp[lo:hi])
                    continue
                if own:
                    held = np.concatenate(own)
                    own = [held]
                    if not done:
                        out.append(_compare(held, held, radius, True))
                        done = True
                    out.append(_compare(held, fp[lo:hi], radius, False))
            if out:
                yield as_batch(out)
        if own and not done:
            held = np.concatenate(own)
            yield as_batch([_compare(held, held, radius, True)])

    def as_batch(found: list) -> pa.RecordBatch:
        a, b = (np.concatenate([f[i] for f in found]).view(np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = tiles.repartition("tile", "part").sortWithinPartitions("tile", "part", "visitor")
    return dealt.mapInArrow(lean(run), "a long, b long")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per document: doc_id, text_hash, fp, root (a fingerprint that stands for
    its group) and component_id (smallest doc_id linked directly or through others)."""
    marked = saved(fingerprints(docs, shingle), "simhash")
    classes = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-classes")
    grouped = components(links(classes, radius))
    joined = classes.join(grouped, classes["fp"] == grouped["node"], "left")
    joined = saved(joined.select("fp", "doc_id", F.coalesce("component", "fp").alias("root")), "simhash-roots")
    least = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = joined.join(least, "root").select("fp", "root", "component_id")
    return marked.join(of, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents without near copies: of each group the row with the
    smallest doc_id stays (of rows with one id and one text, one)."""
    groups = near_groups(docs, shingle, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    key, digest = fresh("_sh_id", docs.columns), fresh("_sh_text", docs.columns)
    stay = groups.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("s"), F.count("*").alias("n"))
    stay = saved(stay.select(F.col("s.doc_id").alias(key), F.col("s.text_hash").alias(digest), "n"), "simhash-stay")
    rows = docs.withColumn(digest, F.xxhash64(whole_text()))
    rows = rows.join(
        stay.drop("n"), rows["doc_id"].eqNullSafe(stay[key]) & (rows[digest] == stay[digest]), "left_semi"
    )
    if not stay.where("n > 1").isEmpty():  # repeated rows: one of each stays
        rows = rows.dropDuplicates(["doc_id", digest])
    return rows.select(*docs.columns)
