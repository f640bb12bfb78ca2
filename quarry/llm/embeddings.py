"""Near-duplicate embeddings through a pivot-permutation index.

Reference vectors (pivots) are taken from a bounded sample of the given
vectors, none close to another, so that a crowd of near copies does not take
them all; every vector is described by its nearest pivots in order.  Two close vectors order
the pivots alike, so they share most of their nearest ones.  The inverted lists
hold, for every two pivots that are both among a vector's nearest, the vectors
of a label; two vectors are candidates where they share at least ``SHARED``
pivots, and the candidate is verified once, in the list of the first two pivots
they share.  Verification is the cosine in double precision.

Equal vectors of a label form one class first.  Lists are cut into parts and
compared part against part in blocks, so no task holds a list, and a block
reports counts and a forest of its links, not all its pairs.

Defined cases: rows whose label is null, or whose vector is null, empty, zero
or holds a null or a value that is not finite, link with nothing, vectors of
different lengths neither; repeated vectors link with each other; rows sharing
a vec_id are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from quarry.llm.common import saved
from quarry.llm.components import components
from quarry.llm.simhash import _forest

#: Cosine from which two vectors link.
COSINE = 0.98
#: Sampled vectors; pivots at most, and the cosine below which they stay; nearest pivots that describe a vector;
#: pivots that candidates share at least.
SAMPLE, PIVOTS, APART, NEAREST, SHARED = 4096, 512, 0.7, 5, 2
#: Lengths of vectors that get pivots (the most common ones; all vectors of another length are compared).
LENGTHS = 8
#: Rows of a part of a list, cells of a block.
PART, BLOCK = 512, 1 << 20


def _can_link() -> Column:
    """Of a row with label and ``v``: whether it can link at all."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return F.col("label").isNotNull() & (F.size("v") > 0) & F.coalesce(finite & some, F.lit(False))


def _units(column: pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors; scaled first, so that no square overflows or vanishes."""
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(classes: DataFrame, pivots: int = PIVOTS) -> dict[int, np.ndarray]:
    """Per vector length, at most ``pivots`` pivots out of the SAMPLE vectors of
    least hash (the same in every run): each is kept if none before it is close."""
    kept = classes.select(F.size("v").alias("dim"), "v", F.xxhash64("v").alias("h"))
    sizes = kept.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
    found = {}
    for row in sizes:
        rows = kept.where(F.col("dim") == row["dim"]).orderBy("h").limit(SAMPLE).select("v").collect()
        x = np.array([r["v"] for r in rows], np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        chosen = x[:1]
        for v in x[1:]:
            if len(chosen) < pivots and (chosen @ v).max() < APART:
                chosen = np.vstack([chosen, v])
        found[row["dim"]] = chosen
    return found


def describe(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST) -> DataFrame:
    """cls, label, v and ``near``: numbers of the nearest pivots, nearest first.
    A vector of a length without pivots is described by pivot 0 and 1 alone, so
    all of that length meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            dims = np.diff(v.offsets.to_numpy())
            near: list = [None] * len(batch)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                ref = pivots.get(int(dim))
                if ref is None or len(ref) < 2:
                    order = np.tile(np.arange(2), (len(at), 1))
                else:
                    k = min(nearest, len(ref))
                    close = -(_units(v.take(pa.array(at))) @ ref.T)
                    order = np.argsort(close, axis=1, kind="stable")[:, :k]
                for i, o in zip(at, order):
                    near[i] = o.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=[*batch.schema.names, "near"]
            )

    return classes.mapInArrow(run, StructType([*classes.schema.fields, StructField("near", ArrayType(IntegerType()))]))


def _lists(described: DataFrame) -> DataFrame:
    """Rows (label, dim, p, q, part, visitor, cls, n, v, near): a class in the list of every two of its pivots.
    Its own part of a list holds it as a member; parts before that one see it as a visitor."""
    rows = described.withColumn("dim", F.size("v")).withColumn("low", F.sort_array("near"))
    pairs = F.flatten(F.transform("low", lambda p: F.transform(
        F.filter("low", lambda q: q > p), lambda q: F.struct(p.alias("p"), q.alias("q")))))
    listed = rows.select("label", "dim", "cls", "n", F.explode(pairs).alias("pq")).select(
        "label", "dim", "pq.p", "pq.q", "cls", "n")
    key = ["label", "dim", "p", "q"]
    parts = listed.groupBy(*key).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    listed = listed.join(parts, key)
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    listed = listed.withColumn("own", own).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("own"))))
    listed = listed.withColumn("visitor", F.col("part") != F.col("own")).drop("own", "parts")
    return listed.join(described.select("cls", "v", "near"), "cls")


def verify(described: DataFrame, cosine: float = COSINE, shared: int = SHARED) -> DataFrame:
    """Links found: rows (a, b, n).  b null: class a links with n vectors of other
    classes there; else a and b are linked directly or through others, n is 0."""

    def block(xa: dict, xb: dict, same: bool, p: int, q: int) -> list[tuple]:
        out = []
        step = max(1, BLOCK // max(1, len(xb["cls"])))
        for k in range(0, len(xa["cls"]), step):
            unit, near = xa["unit"][k:k + step], xa["near"][k:k + step]
            i, j = np.nonzero(unit @ xb["unit"].T >= cosine - 1e-9)
            if same:
                i, j = i[i + k < j], j[i + k < j]
            if not len(i):
                continue
            # the pair belongs to the list of the first two pivots that both have
            both = (near[i][:, :, None] == xb["near"][j][:, None, :]).any(axis=2)
            common = np.where(both, near[i], np.iinfo(np.int32).max)
            first = np.sort(common, axis=1)[:, :2]
            keep = (first[:, 0] == p) & (first[:, 1] == q) & (both.sum(axis=1) >= shared)
            i, j = i[keep], j[keep]
            keep = np.einsum("ij,ij->i", unit[i], xb["unit"][j]) >= cosine
            i, j = i[keep] + k, j[keep]
            for mine, others, ids, weights in ((i, j, xa["cls"], xb["n"]), (j, i, xb["cls"], xa["n"])):
                if len(mine):
                    at, where = np.unique(mine, return_inverse=True)
                    sums = np.bincount(where, weights=weights[others]).astype(np.int64)
                    out.extend((int(c), None, int(s)) for c, s in zip(ids[at], sums))
            a, b = _forest(xa["cls"][i], xb["cls"][j])
            out.extend((int(x), int(y), 0) for x, y in zip(a, b))
        return out

    def load(batch: pa.RecordBatch) -> dict:
        return {"cls": batch.column("cls").to_numpy(), "n": batch.column("n").to_numpy(),
                "unit": _units(batch.column("v")),
                "near": np.asarray(batch.column("near").flatten()).reshape(len(batch), -1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own, done = None, [], False

        def close() -> list[tuple]:
            if not own or done:
                return []
            own[:] = [{k: np.concatenate([o[k] for o in own]) for k in own[0]}]
            return block(own[0], own[0], True, here[2], here[3])

        for batch in batches:
            keys = [batch.column(c).to_pylist() for c in ("label", "dim", "p", "q", "part", "visitor")]
            cuts = [k for k in range(1, len(batch)) if any(c[k] != c[k - 1] for c in keys)]
            out: list[tuple] = []
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                if hi == lo:
                    continue
                at = tuple(c[lo] for c in keys)
                if at[:5] != here:
                    out += close()
                    here, own, done = at[:5], [], False
                some = load(batch.slice(lo, hi - lo))
                if not at[5]:
                    own.append(some)
                    continue
                out += close()
                done = True
                if own:
                    out += block(own[0], some, False, here[2], here[3])
            yield as_batch(out)
        yield as_batch(close())

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])

    key = ["label", "dim", "p", "q", "part"]
    dealt = _lists(described).repartition(*key).sortWithinPartitions(*key, "visitor")
    return dealt.mapInArrow(run, "a long, b long, n long")


def near_groups(
    vectors: DataFrame, vector: str = "embedding", label: str = "label", cosine: float = COSINE,
    pivots: int = PIVOTS, nearest: int = NEAREST, shared: int = SHARED,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``."""
    every = vectors.select("vec_id", F.col(label).alias("label"), F.col(vector).alias("v"))
    rows = saved(every.where(_can_link()), "vectors")
    key = ["label", F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    same = ["label", "h1", "h2"]
    classes = rows.select("vec_id", "v", *key).groupBy(*same).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = saved(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    described = saved(
        describe(classes.select("cls", "label", "n", "v"), choose_pivots(classes, pivots), nearest), "described")
    found = saved(verify(described, cosine, shared), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    grouped = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cls")
    known = classes.select("cls", *same, "least", "n").join(counts, "cls", "left").join(grouped, "cls", "left")
    known = saved(known.withColumn("component", F.coalesce("component", "cls")), "vector-groups")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = saved(known.join(least, "component").select(
        *same, (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), "vector-known")
    linked = rows.select("vec_id", *key).join(known, same).select("vec_id", "n_links", "component_id")
    alone = every.where(~_can_link()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
