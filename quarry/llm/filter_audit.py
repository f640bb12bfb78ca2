"""Filter interaction audit: what each filter removes, in every order of the filters.

Five filters judge whole documents: too few words (A), repeated words (B), too
many capitals (C), marks (D), a copy of a document of smaller id (E).  Every
document gets a mask of the filters it fails; all orders follow from the counts
of the masks.

Copies are found with text tries.  Texts are dealt out by adaptive prefixes:
a prefix that holds too large a share of all bytes is lengthened, so that no
prefix but a single text is large, and range-partitioned.  A task inserts the
full texts of one prefix after another into a compressed (radix) trie whose
terminals hold the least doc_id and the rows that end there; traversing it gives
every row its flag.  Copies within a batch meet before the shuffle, so a text
travels at most once a batch, whoever holds it.

Defined cases: null text is empty; a null doc_id is no id: the row is never a
copy and makes none; rows of one id and text are not copies of each other, each
counts; a document with several labels has one if any row says so; a null lang
counts as the empty string; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved, shuffle_partitions, whole_text

#: Filters; words that a document needs; distinct words and capitals of a hundred.
FILTERS, WORDS, DISTINCT, CAPITALS = "ABCDE", 100, 80, 10
COPY = 1 << FILTERS.index("E")
#: Characters of the first prefixes, by how much they are lengthened, and shares of all bytes (a partition's part) they
#: may hold.
PREFIX, LONGER, SHARES = 8, 3, 4
#: Rows and bytes of texts in a trie from which the next prefix begins a new one.
ROWS, BYTES = 20_000, 16 << 20

_CAPITALS, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"


def text_mask(data: bytes) -> int:
    """Filters A to D that a text (UTF-8) fails, as bits."""
    words = data.split()  # bytes: runs without space, tab and 0A-0D
    chars = len(data) if data.isascii() else len(data.decode("utf-8", "replace"))
    return (
        (len(words) < WORDS)
        | (100 * len(set(words)) < DISTINCT * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, _CAPITALS))) > CAPITALS * chars) << 2
        | (len(data.translate(None, _MARKS)) < len(data)) << 3
    )


MASKED = "doc_id long, lang string, mask int, n long, text binary"


def _masked(docs: DataFrame) -> DataFrame:
    """Documents with their mask.  Rows of a batch with one text meet here: only those of the least id keep the text
    (the others are copies), one row per doc_id and lang."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by = {}
            for d, lang, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")]):
                of = by.setdefault(text, {})
                of[d, lang] = of.get((d, lang), 0) + 1
            out = []
            for text, of in by.items():
                mask, least = text_mask(text), min((d for d, _ in of if d is not None), default=None)
                for (d, lang), n in of.items():
                    copy = d is not None and d > least
                    out.append((d, lang, mask | (COPY if copy else 0), n, None if copy or d is None else text))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                names=["doc_id", "lang", "mask", "n", "text"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("lang"), whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(run, MASKED)


def adaptive_prefix(texts: DataFrame, shares: int) -> Column:
    """The start of ``text`` that its row is dealt by: as long as needed for no prefix, but one whole text, to hold more
    than one of ``shares`` of all bytes.  Prefixes are free of each other, so they sort as the texts do.  The driver
    holds the hashes of the heavy ones, at most ``shares`` a length."""
    size = F.octet_length("text").cast("long")
    total = texts.agg(F.sum(size)).first()[0] or 0
    rows, at, lengths = texts.select("text"), PREFIX, []
    while True:
        start = F.substring("text", 1, at)
        heavy = rows.where(F.octet_length("text") > at).groupBy(F.xxhash64(start).alias("h")).agg(F.sum(size).alias("size"))
        heavy = [r["h"] for r in heavy.where(F.col("size") > total / shares).collect()]
        lengths.append((at, heavy))
        if not heavy:
            break
        rows, at = rows.where((F.octet_length("text") > at) & F.xxhash64(start).isin(heavy)), at * LONGER
    out = F.substring("text", 1, lengths[-1][0])
    for at, heavy in reversed(lengths[:-1]):
        start = F.substring("text", 1, at)
        out = F.when(F.xxhash64(start).isin(heavy) & (F.octet_length("text") > at), out).otherwise(start)
    return out


class Trie:
    """A compressed trie of byte strings; terminals hold the least id and the rows that end there."""

    __slots__ = ("label", "kids", "least", "rows")

    def __init__(self, label: bytes = b"") -> None:
        self.label, self.kids, self.least, self.rows = label, {}, None, None

    def insert(self, key: bytes, doc_id: int, row: int) -> None:
        node, at, n = self, 0, len(key)
        while at < n:
            kid = node.kids.get(key[at])
            if kid is None:
                kid = node.kids[key[at]] = Trie(key[at:])
            elif not key.startswith(kid.label, at):
                same = _common(kid.label, key, at)
                mid = node.kids[key[at]] = Trie(kid.label[:same])
                kid.label = kid.label[same:]
                mid.kids[kid.label[0]] = kid
                kid = mid
            node, at = kid, at + len(kid.label)
        if node.rows is None:
            node.least, node.rows = doc_id, []
        node.least = min(node.least, doc_id)
        node.rows.append((row, doc_id))

    def copies(self) -> Iterator[int]:
        """Rows whose text ends where a smaller id does."""
        todo = [self]
        while todo:
            node = todo.pop()
            todo += node.kids.values()
            for row, doc_id in node.rows or ():
                if doc_id > node.least:
                    yield row


def _common(label: bytes, key: bytes, at: int) -> int:
    """Bytes that ``label`` and ``key`` from ``at`` on share, by halving."""
    lo, hi = 0, min(len(label), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if key.startswith(label[lo:mid], at + lo):
            lo = mid
        else:
            hi = mid - 1
    return lo


JUDGED = "doc_id long, lang string, mask int, n long"


def _flagged(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` with the bit of copies, by a trie per prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            for k in trie.copies():
                rows[k][2] |= COPY
            cols = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int64()))],
                names=["doc_id", "lang", "mask", "n"])

        trie, rows, prefix, size = Trie(), [], None, 0
        for batch in batches:
            for here, text, *row in zip(*[batch.column(c).to_pylist() for c in ("prefix", "text", "doc_id", "lang", "mask", "n")]):
                if here != prefix and (len(rows) >= ROWS or size >= BYTES):
                    yield done()
                    trie, rows, size = Trie(), [], 0
                trie.insert(text, row[0], len(rows))
                rows.append(row)
                prefix, size = here, size + len(text)
        yield done()

    rows = texts.withColumn("prefix", adaptive_prefix(texts, SHARES * shuffle_partitions(texts.sparkSession)))
    rows = rows.repartitionByRange(shuffle_partitions(texts.sparkSession), "prefix").sortWithinPartitions("prefix")
    return rows.select("prefix", "text", "doc_id", "lang", "mask", "n").mapInArrow(run, JUDGED)


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, lang, mask and n: the filters that documents fail; rows alike in id, lang and text may be one, n times."""
    masked = saved(_masked(docs), "audit-masked")
    known = masked.where("text IS NULL").drop("text")
    return known.unionByName(_flagged(masked.where("text IS NOT NULL")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per lang (``part``), order of the filters and step: documents kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley."""
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    rows = masks(docs).join(marks, F.col("doc_id") == F.col("id"), "left")
    counts = rows.groupBy(F.col("lang").alias("part"), "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])
    orders = ["".join(p) for p in permutations(FILTERS)]
    orders = F.explode(F.array(*[F.lit(o) for o in orders])).alias("filter_order")
    steps = saved(counts, "audit-masks").select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = lambda k: F.expr(f"shiftleft(1, ascii(substring(filter_order, {k}, 1)) - ascii('{FILTERS[0]}'))")
    before = sum((F.when(F.col("step") > k, bit(k)).otherwise(0) for k in range(1, len(FILTERS))), F.lit(0))
    own, passed = F.col("mask").bitwiseAND(bit("step")) != 0, F.col("mask").bitwiseAND(before) == 0
    total = lambda what, when: F.sum(F.when(when, F.col(what)).otherwise(F.lit(0))).cast("long").alias
    result = steps.groupBy("part", "filter_order", "step").agg(
        total("n", ~own & passed)("kept"), total("n", own & passed)("removed"), total("n", own & ~passed)("redundant"),
        total("n", F.col("mask") == bit("step"))("unique_fails"), total("good", own & passed)("good_lost"),
        total("toxic", own & passed)("toxic_lost"))
    name = F.expr("substring(filter_order, step, 1)")
    result = saved(result.withColumn("name", name), "audit-steps")
    shapley = result.groupBy("part", "name").agg(F.sum("removed").alias("shapley"))
    return result.join(shapley, ["part", "name"]).drop("name")
