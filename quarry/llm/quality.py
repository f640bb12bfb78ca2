"""Quality classifier by positive-unlabelled learning.

The classifier sees trusted positives (labelled good, outside the held-out
fold) and unlabelled documents; it minimises the non-negative unbiased risk

    prior * loss(positives, +1) + max(0, loss(unlabelled, -1) - prior * loss(positives, -1))

of a linear model over features of the text alone (sizes, variety, character
and line statistics, byte frequencies).  The class prior is estimated as the
share of good ones among all labelled rows outside the fold.  The fit reads at
most POSITIVES + UNLABELLED documents, those of least hashed id; every document
is scored, whole.

Defined cases: null and empty texts have the features of an empty text; rows
without an id are not held out and not learned from; without any label, or any
positive, every score is the prior (0.5 without labels); repeated rows score
alike; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, lean, saved, whole_text

#: Bounds of the sample that the fit reads.
POSITIVES, UNLABELLED = 5000, 10000
#: Folds of crc32(doc_id), of which fold 0 is held out; score from which a document is kept.
FOLDS, THRESHOLD = 5, 0.3
#: Steps and rate of the descent, weight of the squared weights, step back when the negative risk is below zero.
STEPS, RATE, DECAY, BACK = 300, 0.05, 1e-2, 1.0


def features(text: str) -> np.ndarray:
    """Numbers of a text that neither its length nor its language decides alone."""
    data = text.encode("utf-8", "surrogatepass")
    n = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), data.split(b"\n")
    unique, longest = set(words), max(map(len, words), default=0)
    m = max(1, len(words))
    upper, digit = counts[65:91].sum(), counts[48:58].sum()
    letters = upper + counts[97:123].sum() + counts[128:].sum()
    again = sum(map(eq, words, words[1:]))
    ends = sum(1 for line in lines if line.rstrip()[-1:] in (b".", b"!", b"?", b'"'))
    own = np.array([
        np.log1p(len(words)), np.log1p(len(lines)), len(unique) / m, sum(map(len, unique)) / max(1, len(unique)) / 10,
        min(longest, 1000) / 100, (n - letters) / n, upper / n, digit / n, len(set(lines)) / len(lines),
        ends / len(lines), counts[32] / n, float(not words), again / m, float(again > 0.1 * m),
    ])
    return np.concatenate([own, np.sqrt(counts / n)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias over raw features."""
    every = np.vstack([positive, unlabelled])
    mean, spread = every.mean(axis=0), every.std(axis=0)
    spread[spread < 1e-9] = np.inf  # a constant feature says nothing
    p, u = ((x - mean) / spread for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def sigmoid(z):
        return 0.5 * (1 + np.tanh(z / 2))

    for step in range(1, STEPS + 1):
        sp, su = sigmoid(p @ w + b), sigmoid(u @ w + b)
        # sigmoid loss: loss(z, +1) = 1 - s, loss(z, -1) = s
        negative = su.mean() - prior * sp.mean()
        gp, gu = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        up = np.append(gp @ p, gp.sum())
        un = np.append(gu @ u, gu.sum())
        grad = -prior * up + (un - prior * up) if negative >= 0 else -BACK * (un - prior * up)
        grad[:-1] += DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w / spread, float(b - (w / spread) @ mean)


def _featured(docs: DataFrame, mark: str) -> list[tuple[bool, bool, np.ndarray]]:
    """Marks and features of a bounded number of documents, on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype("<f8").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column(mark), pa.array(found, pa.binary())], names=[mark, "x"])

    rows = docs.select(mark, whole_text().alias("text")).mapInArrow(lean(run), f"{mark} int, x binary")
    return [(r[mark], np.frombuffer(r["x"], "<f8")) for r in rows.collect()]


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float, float]:
    """Weights, bias and prior from ``docs`` and ``labels`` (doc_id, quality)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    stats = known.agg(F.avg(F.col("quality").cast("double")).alias("prior"), F.sum("quality").alias("good")).first()
    if not stats["good"]:
        return np.zeros(0), 0.0, 0.5 if stats["prior"] is None else float(stats["prior"])
    order = F.xxhash64("doc_id")

    def least(rows: DataFrame, n: int) -> DataFrame:
        return rows.select("doc_id").distinct().orderBy(order, "doc_id").limit(n)

    free = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    good = least(known.where(F.col("quality") == 1), POSITIVES).withColumn("mark", F.lit(1))
    some = least(free, UNLABELLED).withColumn("mark", F.lit(2))
    marks = saved(good.unionByName(some).groupBy("doc_id").agg(F.sum("mark").cast("int").alias("mark")), "marks")
    # at most POSITIVES + UNLABELLED rows
    rows = _featured(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id"), "mark")
    positive = [x for mark, x in rows if mark & 1]
    unlabelled = [x for mark, x in rows if mark & 2]
    prior = min(max(float(stats["prior"]), 1e-3), 1 - 1e-3)
    if not positive or not unlabelled:
        return np.zeros(0), 0.0, prior
    w, b = fit(np.array(sorted(map(tuple, positive))), np.array(sorted(map(tuple, unlabelled))), prior)
    return w, b, prior


def score(docs: DataFrame, model: tuple[np.ndarray, float, float], out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text in column ``out``."""
    w, b, prior = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(w):
                z = np.array([features(t.as_py() or "") @ w + b for t in batch.column("text")], float)
                s = 0.5 * (1 + np.tanh(z / 2))
            else:
                s = np.full(len(batch), prior)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*batch.schema.names, out])

    schema = docs.withColumn(out, F.lit(0.0)).schema
    return docs.mapInArrow(lean(run), schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, with the columns of ``docs``."""
    name = fresh("_q_score", docs.columns)
    return score(docs, train(docs, labels), name).where(F.col(name) >= threshold).drop(name)
