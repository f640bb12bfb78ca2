"""Suffix-array dedup: later copies of byte strings go, the first stays.

Every byte covered by a string of ``least`` bytes that also starts in a document
of smaller doc_id is removed.  Texts are judged as they came, as UTF-8 bytes.

Suffixes that may match are brought together by anchors: of every window of
``least`` bytes the ``gram`` bytes of least hash.  Equal windows have equal
anchors, so an anchor that stands in one text only needs no further look.  For
the others the surroundings (all windows that chose this anchor) of all texts
meet in one task, which builds the suffix array of the windows' starts with its
common-prefix lengths, finds for every suffix the previous and the next one in
suffix order that belong to a smaller doc_id, and from them the longest previous
factor.  A window whose factor is as long as the window goes.

Nothing hot meets in one place: equal texts are one text, known by its smallest
doc_id; equal surroundings of a slice of texts travel once, and the later ones
are settled there; an anchor of more than ``HOT`` texts is dealt out again by
the whole windows around it.  Texts are written once, bucketed by their digest,
so that the two joins with them move only what is joined to them.

Defined cases: null text is empty; texts of under ``least`` bytes lose nothing;
a null doc_id is smaller than all others; rows with one id never remove from
each other; rows with one id and text get the same result, once per row; very
long texts are read in blocks; an empty table gives no rows; other columns are
left out by ``removed_spans`` and kept by ``dedup``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, saved, scratch, shuffle_partitions, whole_text

#: Bytes of a string that counts as repeated, and of an anchor.
LEAST, GRAM = 50, 20
#: Texts of one anchor from which it is dealt out by whole windows.
HOT = 20_000
#: Windows read at once from a text, bytes in a slice of texts (at most 2**21).
BLOCK, SLICE = 1 << 19, 1 << 20
#: Anchors and surroundings packed at once, windows sorted at once.
ANCHORS, AROUNDS, CHUNK = 1_000_000, 150_000, 200_000

_MIX, _ODD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_PLACE = (1 << 21) - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of data[i:i + k] for every i, by doubling; the last k - 1 mean nothing."""
    def ahead(h: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([h[by:], np.zeros(min(by, len(h)), np.uint64)]) if by else h

    power = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_MIX))[data]
    size, at, out = 1, 0, None
    while size <= k:
        times = np.uint64(pow(_ODD, size, 1 << 64))
        if k & size:
            out = ahead(power, at) if out is None else out * times + ahead(power, at)
            at += size
        if 2 * size <= k:
            power = power * times + ahead(power, size)
        size *= 2
    return _mixed(out)


def _least_ahead(values: np.ndarray, w: int) -> np.ndarray:
    """Least of the w values from here on."""
    out, have = values.copy(), 1
    while have < w:
        by = min(have, w - have)
        out[:-by] = np.minimum(out[:-by], out[by:])
        have += by
    return out


class Pieces:
    """A slice of texts as one run of bytes: pieces of rows, with their place in the text."""

    def __init__(self) -> None:
        self.rows, self.at, self.parts, self.size = [], [], [], 0

    def add(self, row: int, at: int, part: bytes) -> None:
        self.rows.append(row)
        self.at.append(at)
        self.parts.append(part)
        self.size += len(part)

    def anchors(self, least: int, gram: int, parts: int) -> tuple[np.ndarray, ...]:
        """Per run of windows with one anchor: piece, first and last window (place in ``data``), and the anchor's key."""
        self.data = np.frombuffer(b"".join(self.parts), np.uint8)
        sizes = np.array([len(p) for p in self.parts])
        self.starts = np.cumsum(sizes) - sizes
        hashes = gram_hashes(self.data, gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        best = _least_ahead((hashes & ~np.uint64(_PLACE)) | places, least - gram + 1)
        windows = np.maximum(sizes - least + 1, 0)
        start = np.repeat(self.starts - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
        chosen = (best[start] & np.uint64(_PLACE)).astype(np.int64)
        first = np.flatnonzero(np.diff(chosen, prepend=-1))
        last = np.append(first[1:], len(chosen)) - 1
        piece = np.searchsorted(self.starts, start[first], side="right") - 1
        return piece, start[first], start[last], _keys(hashes[chosen[first]], parts)


def _keys(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of a hash, above 32 bits of it."""
    h = _mixed(hashes)
    return ((h >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | h & np.uint64(2**32 - 1)


def _slices(batch: pa.RecordBatch, least: int) -> Iterator[Pieces]:
    """Slices of the texts of a batch; a long text is cut into blocks that overlap by a window."""
    held = Pieces()
    for row, text in enumerate(batch.column("text")):
        text = text.as_buffer()
        for at in range(0, text.size - least + 1, BLOCK):
            part = text[at:at + BLOCK + least - 1].to_pybytes()
            if held.size and held.size + len(part) > SLICE:
                yield held
                held = Pieces()
            held.add(row, at, part)
    if held.size:
        yield held


def texts_of(docs: DataFrame) -> DataFrame:
    """One row per distinct text: its digests h1 and h2, its smallest doc_id (``first``) and the text as bytes; bucketed
    by the digests."""
    spark, n = docs.sparkSession, shuffle_partitions(docs.sparkSession)
    rows = docs.select(*_digests(), F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id").alias("id"),
                       whole_text().cast("binary").alias("text"))
    kinds = rows.groupBy("h1", "h2").agg(F.min("id")["doc_id"].cast("long").alias("first"), F.first("text").alias("text"))
    name = f"quarry_llm_texts_{uuid.uuid4().hex}"
    kept = kinds.write.format("parquet").bucketBy(n, "h1", "h2").sortBy("h1", "h2")
    kept.option("path", scratch(spark, "suffix-texts")).saveAsTable(name)
    return spark.table(name)


def _digests() -> list:
    """96 bits that stand for a text: xxHash64 and Murmur3."""
    text = whole_text()
    return [F.xxhash64(text).alias("h1"), F.hash(F.lit(7), text).alias("h2")]


GRAMS = "part int, grams binary, counts binary, h1s binary, h2s binary"


def _grams(texts: DataFrame, least: int, gram: int, parts: int) -> DataFrame:
    """Anchors of all texts, packed: rows of a part hold the anchors of some texts, each once a text."""
    def packed(held: list[tuple]) -> pa.RecordBatch:
        key, row = (np.concatenate([x[c] for x in held]) for c in (0, 1))
        _, row, own = np.unique(row, return_index=True, return_inverse=True)
        h1, h2 = (np.concatenate([x[c] for x in held])[row] for c in (2, 3))
        order = np.lexsort((key, own, key >> np.uint64(32)))
        key, own = key[order], own[order]
        new = np.flatnonzero((np.diff(key, prepend=~key[:1]) != 0) | (np.diff(own, prepend=-1) != 0))
        key, own = key[new], own[new]
        out = []
        for part, lo, hi in _runs(key >> np.uint64(32)):
            mine, counts = np.unique(own[lo:hi], return_counts=True)
            out.append((part, key[lo:hi].astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(),
                        h1[mine].tobytes(), h2[mine].tobytes()))
        return _batch(out, GRAMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, base = [], 0
        for batch in batches:
            h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
            for some in _slices(batch, least):
                piece, _, _, key = some.anchors(least, gram, parts)
                row = np.array(some.rows)[piece]
                held.append((key, row + base, h1[row], h2[row]))
                if sum(len(x[0]) for x in held) >= ANCHORS:
                    yield packed(held)
                    held = []
            base += batch.num_rows
        if held:
            yield packed(held)

    return texts.select("h1", "h2", "text").mapInArrow(run, GRAMS)


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of equal values: value, first place and end."""
    if not len(values):
        return []
    cuts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return list(zip(values[cuts].tolist(), cuts.tolist(), np.append(cuts[1:], len(values)).tolist()))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def _by_part(packed: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on the rows of each part; ``work`` gets lists of the columns after ``part``."""
    names = packed.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for number, *row in zip(*[batch.column(c).to_pylist() for c in ("part", *names)]):
                if number != at and rows:
                    yield from work(at, rows)
                    rows = []
                at = number
                rows.append(row)
        if rows:
            yield from work(at, rows)

    dealt = packed.repartition(shuffle_partitions(packed.sparkSession), "part")
    return dealt.sortWithinPartitions("part").mapInArrow(run, schema)


SHARED = "h1 long, h2 int, keys binary"


def _shared(grams: DataFrame, hot: int) -> DataFrame:
    """Per text, in rows of some anchors each: keys of its anchors that another text has, twice the key plus one if hot."""
    def work(number: int, rows: list[list]) -> Iterator[pa.RecordBatch]:
        gram, counts, h1, h2 = (np.concatenate([np.frombuffer(r[c], t) for r in rows])
                                for c, t in enumerate((np.uint32, np.uint32, np.int64, np.int32)))
        owner = np.repeat(np.arange(len(counts)), counts)
        _, at, times = np.unique(gram, return_inverse=True, return_counts=True)
        times = times[at]
        some = np.flatnonzero(times > 1)
        key = (np.uint64(number) << np.uint64(33)) | (gram[some].astype(np.uint64) << np.uint64(1)) | (times[some] > hot)
        data = key.astype(np.uint64).tobytes()
        out = [(int(h1[o]), int(h2[o]), data[8 * lo:8 * hi]) for o, lo, hi in _runs(owner[some])]
        for k in range(0, len(out), 50_000):
            yield _batch(out[k:k + 50_000], SHARED)

    return _by_part(grams, work, SHARED)


AROUND = "part int, grams binary, places binary, windows binary, around binary, counts binary, h1s binary, h2s binary, firsts binary, spans binary"
_FIRST = -(1 << 63)


def _around(texts: DataFrame, shared: DataFrame, least: int, gram: int, parts: int) -> DataFrame:
    """Surroundings of shared anchors, packed by part of the anchor.  Of equal ones the one with the smallest doc_id
    travels, once for all its places (those after the first as zero windows); the others repeat it: their spans (from,
    to) are known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, base, n = [], 0, 0
        for batch in batches:
            h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
            first = np.array([_FIRST if f is None else f for f in batch.column("first").to_pylist()], np.int64)
            wanted = [np.frombuffer(b"".join(k), np.uint64) for k in batch.column("keys").to_pylist()]
            for some in _slices(batch, least):
                key, row, place, windows, texts = _wanted(some, wanted, least, gram, parts)
                held.append((key, row + base, place, windows, h1[row], h2[row], first[row], texts))
                n += len(key)
                if n >= AROUNDS:
                    yield _settled(held, least)
                    held, n = [], 0
            base += batch.num_rows
        if n:
            yield _settled(held, least)

    keys = shared.groupBy("h1", "h2").agg(F.collect_list("keys").alias("keys"))
    return texts.join(keys, ["h1", "h2"]).select("h1", "h2", "first", "text", "keys").mapInArrow(run, AROUND)


def _wanted(some: Pieces, wanted: list[np.ndarray], least: int, gram: int, parts: int) -> tuple:
    """The surroundings of the wanted anchors of a slice: key, row, place in the text, windows, bytes."""
    piece, lo, hi, key = some.anchors(least, gram, parts)
    rows, salt = np.array(some.rows), lambda r: r.astype(np.uint64) * np.uint64(_MIX)
    known = np.concatenate([wanted[r] for r in sorted(set(some.rows))])
    hot = (known & np.uint64(1)).astype(bool)
    known = (known >> np.uint64(1)) ^ salt(np.repeat(*zip(*((r, len(wanted[r])) for r in sorted(set(some.rows))))))
    order = np.argsort(known)
    known, hot = known[order], hot[order]
    own = key ^ salt(rows[piece])
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    found = np.flatnonzero(known[at] == own)
    piece, lo, hi, key, hot = piece[found], lo[found], hi[found], key[found], hot[at[found]]
    if hot.any():  # every window on its own, by the hash of all of it
        n = (hi - lo + 1)[hot]
        start = np.repeat(lo[hot], n) + _inside(n)
        whole = _keys(gram_hashes(some.data, least)[start], parts)
        piece, lo, hi, key = (np.concatenate([x[~hot], y]) for x, y in
                              ((piece, np.repeat(piece[hot], n)), (lo, start), (hi, start), (key, whole)))
    data = some.data.tobytes()
    texts = [data[a:b] for a, b in zip(lo.tolist(), (hi + least).tolist())]
    return key, rows[piece], lo - some.starts[piece] + np.array(some.at)[piece], hi - lo + 1, texts


def _inside(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1, ..."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _settled(held: list[tuple], least: int) -> pa.RecordBatch:
    key, row, place, windows, h1, h2, first = (np.concatenate([x[c] for x in held]) for c in range(7))
    texts = [t for x in held for t in x[7]]
    best, gone, order = {}, [], first.tolist()
    for k, seen in enumerate(zip(key.tolist(), texts)):
        have = best.setdefault(seen, [])
        if have and order[k] > order[have[0]]:
            gone.append(k)
            continue
        if have and order[k] < order[have[0]]:
            gone += have
            have.clear()
        have.append(k)
    lead = np.full(len(key), -1, np.int64)
    for have in best.values():
        by_row = {}
        for k in have:
            lead[k] = by_row.setdefault(int(row[k]), k)
    ship = np.flatnonzero(lead >= 0)
    ship = ship[np.lexsort((ship, lead[ship], row[ship], key[ship] >> np.uint64(32)))]
    out = []
    for part, x, y in _runs(key[ship] >> np.uint64(32)):
        some = ship[x:y]
        heads = lead[some] == some
        own = _runs(row[some])
        at = some[[lo for _, lo, _ in own]]
        out.append((part, key[some].astype(np.uint32).tobytes(), place[some].astype(np.uint32).tobytes(),
                    np.where(heads, windows[some], 0).astype(np.uint8).tobytes(),
                    pa.compress(b"".join(texts[k] for k in some[heads].tolist()), "zstd", asbytes=True),
                    np.array([hi - lo for _, lo, hi in own], np.uint32).tobytes(),
                    h1[at].tobytes(), h2[at].tobytes(), first[at].tobytes(), None))
    if gone:
        gone = np.array(gone)
        gone = gone[np.lexsort((place[gone], row[gone]))]
        own = _runs(row[gone])
        at = gone[[lo for _, lo, _ in own]]
        spans = np.stack([place[gone], place[gone] + windows[gone] + least - 1], axis=1).astype(np.uint32)
        out.append((int(key[gone[0]] >> np.uint64(32)), None, None, None, None,
                    np.array([hi - lo for _, lo, hi in own], np.uint32).tobytes(), h1[at].tobytes(), h2[at].tobytes(), None, spans.tobytes()))
    return _batch(out, AROUND)


def smaller_before(values: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix in order, the nearest one before it of smaller value (-1: none) and their common prefix.
    ``lcp[i]`` is the common prefix of suffixes i - 1 and i.  All suffixes jump at once: over the one before them, and
    as far as it jumped itself, as long as the value there is not smaller."""
    near, common = np.arange(len(values)) - 1, lcp.copy()
    open_ = np.flatnonzero(near >= 0)
    while len(open_):
        open_ = open_[values[near[open_]] >= values[open_]]
        over = near[open_]
        near[open_], common[open_] = near[over], np.minimum(common[open_], common[over])
        open_ = open_[near[open_] >= 0]
    common[near < 0] = 0
    return near, common


def previous_factors(suffixes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Longest prefix that every suffix (a row of bytes) shares with one of smaller value: its longest previous factor,
    through the previous and the next smaller value in suffix order."""
    n, width = suffixes.shape
    order = np.argsort(suffixes.view(f"S{width}").ravel(), kind="stable")
    placed, value = suffixes[order], values[order]
    lcp = np.zeros(n, np.int64)
    for k in range(1, n, 50_000):  # bounded blocks
        differ = placed[k:k + 50_000] != placed[k - 1:min(k + 50_000, n) - 1]
        lcp[k:k + 50_000] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    _, before = smaller_before(value, lcp)
    back = np.concatenate([[0], lcp[:0:-1]])
    _, after = smaller_before(value[::-1], back)
    out = np.empty(n, np.int64)
    out[order] = np.maximum(before, after[::-1])
    return out


SPANS = "h1 long, h2 int, spans binary"


def _repeats(around: DataFrame, least: int) -> DataFrame:
    """Spans (from, to) of texts that repeat a text of smaller doc_id."""
    def given(owner, spans, h1, h2) -> Iterator[pa.RecordBatch]:
        data = spans.astype(np.uint32).tobytes()
        out = [(int(h1[o]), int(h2[o]), data[8 * x:8 * y]) for o, x, y in _runs(owner)]
        for k in range(0, len(out), 50_000):
            yield _batch(out[k:k + 50_000], SPANS)

    def work(number: int, rows: list[list]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            if r[-1] is not None:
                counts = np.frombuffer(r[4], np.uint32)
                yield from given(np.repeat(np.arange(len(counts)), counts), np.frombuffer(r[-1], np.uint32).reshape(-1, 2),
                                 np.frombuffer(r[5], np.int64), np.frombuffer(r[6], np.int32))
        rows = [r for r in rows if r[-1] is None]
        if not rows:
            return
        gram, place, windows, counts, h1, h2, first = (
            np.concatenate([np.frombuffer(r[c], t) for r in rows])
            for c, t in ((0, np.uint32), (1, np.uint32), (2, np.uint8), (4, np.uint32), (5, np.int64), (6, np.int32), (7, np.int64)))
        owner, windows, place = np.repeat(np.arange(len(counts)), counts), windows.astype(np.int64), place.astype(np.int64)
        heads = np.flatnonzero(windows)
        places = np.diff(np.append(heads, len(windows)))  # a head and the zero windows after it
        size = windows[heads] + least - 1
        data = np.frombuffer(b"".join(_unpacked(r[3], r[2], least) for r in rows), np.uint8)
        start = np.cumsum(size) - size
        order = np.argsort(gram[heads], kind="stable")
        lists = [(x, y) for _, x, y in _runs(gram[heads[order]]) if y > x + 1]  # alone, an anchor repeats nothing
        k = 0
        while k < len(lists):  # whole lists of anchors: CHUNK windows, or one list
            some, n = [], 0
            while k < len(lists) and (n < CHUNK or not some):
                some.append(order[slice(*lists[k])])
                n += int(windows[heads[some[-1]]].sum())
                k += 1
            some = np.concatenate(some)
            n = windows[heads[some]]
            inside = _inside(n)
            suffixes = np.lib.stride_tricks.sliding_window_view(data, least)[np.repeat(start[some], n) + inside]
            factors = previous_factors(np.ascontiguousarray(suffixes), np.repeat(first[owner[heads[some]]], n))
            gone = np.flatnonzero(factors >= least)
            if not len(gone):
                continue
            which, at = np.repeat(some, n)[gone], inside[gone]
            cut = np.flatnonzero((np.diff(which, prepend=-1) != 0) | (np.diff(at, prepend=-9) != 1))
            last = np.append(cut[1:], len(at)) - 1
            which, lo, hi = which[cut], at[cut], at[last] + least
            times = places[which]
            here = np.repeat(heads[which], times) + _inside(times)
            spans = np.stack([place[here] + np.repeat(lo, times), place[here] + np.repeat(hi, times)], axis=1)
            by = np.lexsort((spans[:, 0], owner[here]))
            yield from given(owner[here][by], spans[by], h1, h2)

    return _by_part(around, work, SPANS)


def _unpacked(around: bytes, windows: bytes, least: int) -> bytes:
    n = np.frombuffer(windows, np.uint8).astype(np.int64)
    return pa.decompress(around, int(n.sum() + (n > 0).sum() * (least - 1)), "zstd", asbytes=True)


CUT = "h1 long, h2 int, first long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _cut(texts: DataFrame, spans: DataFrame, keep: bool) -> DataFrame:
    """Per text what is left of it: counts, digest and, if ``keep``, the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            out = []
            for h1, h2, first, text, spans in zip(*[batch.column(c).to_pylist() for c in ("h1", "h2", "first", "text", "spans")]):
                kept, runs, gone, end = [], 0, 0, -1
                for a, b in sorted(map(tuple, np.frombuffer(b"".join(spans or []), np.uint32).reshape(-1, 2).tolist())):
                    if a > end:
                        kept.append(text[max(end, 0):a])
                        runs, gone, end = runs + 1, gone + b - a, b
                    elif b > end:
                        gone, end = gone + b - end, b
                kept = b"".join([*kept, text[max(end, 0):]])
                out.append((h1, h2, first, len(text), gone, runs, hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "replace") if keep else None))
            yield _batch(out, CUT)

    joined = spans.groupBy("h1", "h2").agg(F.collect_list("spans").alias("spans"))
    rows = texts.join(joined, ["h1", "h2"], "left").select("h1", "h2", "first", "text", "spans")
    return rows.mapInArrow(run, CUT)


def judged(docs: DataFrame, least: int = LEAST, gram: int = GRAM, hot: int = HOT, keep: bool = False) -> DataFrame:
    """Per distinct text: digests, smallest doc_id, and what is left of the text in that document."""
    if not 0 < gram <= least or least > 250:
        raise ValueError("0 < gram <= least <= 250")
    parts, texts = shuffle_partitions(docs.sparkSession), texts_of(docs)
    shared = saved(_shared(_grams(texts, least, gram, parts), hot), "suffix-shared")
    spans = saved(_repeats(_around(texts, shared, least, gram, parts), least), "suffix-spans")
    return _cut(texts, spans, keep)


def _later(first: str) -> F.Column:
    """Whether the row's doc_id is larger than the smallest of its text."""
    return F.col("doc_id").isNotNull() & (F.col(first).isNull() | (F.col("doc_id") > F.col(first)))


def removed_spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    cut = saved(judged(docs, least, gram, hot).drop("kept"), "suffix-cut")
    rows = docs.select("doc_id", *_digests()).join(cut, ["h1", "h2"])
    whole = _later("first") & (F.col("n_bytes") >= least)  # a later copy of the text
    return rows.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def dedup(docs: DataFrame, least: int = LEAST, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """The documents with the bytes that stay as text; cut characters become U+FFFD.  ``n_chars`` is counted again."""
    names = {c: fresh(f"_sx_{c}", docs.columns) for c in ("h1", "h2", "first", "kept")}
    cut = judged(docs, least, gram, hot, keep=True).select(*[F.col(c).alias(n) for c, n in names.items()], F.col("n_bytes").alias("_sx_n"))
    digests = dict(zip(("h1", "h2"), _digests()))
    rows = docs.withColumns({names[c]: d for c, d in digests.items()}).join(cut, [names["h1"], names["h2"]])
    whole = _later(names["first"]) & (F.col("_sx_n") >= least)
    text = F.when(whole, F.lit("")).otherwise(F.col(names["kept"]))
    fields = {"text": F.when(F.col("text").isNotNull(), text)}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.coalesce(F.char_length(text), F.lit(0)).cast(dict(docs.dtypes)["n_chars"])
    return rows.select(*[fields[c].alias(c) if c in fields else F.col(c) for c in docs.columns])
