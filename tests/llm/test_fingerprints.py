"""Fingerprints against a plain version of the same rule and against true shingle overlap."""

import hashlib
import random
import re

import xxhash

from quarry.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, tie string, place string"


def hashes(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return set()
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def overlap(a, b):
    x, y = hashes(a), hashes(b)
    return 1.0 if x == y else len(x & y) / len(x | y)


def rows():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocabulary) for _ in range(900)]
    out = [(i, " ".join(base[: 30 * (i + 1)])) for i in range(25)]
    out += [(50 + i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([3, 20, 60, 200, 1500])))) for i in range(40)]
    out += [(200, None), (201, ""), (202, "\n \t"), (203, "one"), (204, "É\x85x 中"), (205, "x" * 20000)]
    out += [(300, "same text here with several words"), (301, "same text here with several words"), (301, "b c"), (301, "b c")]
    return out + [(None, "null id"), (None, "another null id")]


def test_every_column(spark):
    docs = spark.createDataFrame([(d, t, "clash", "clash") for d, t in rows()], SCHEMA).repartition(4)
    got = fp.compare(docs).collect()
    key = lambda t: xxhash.xxh64_intdigest(t.encode(), 42)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    order = sorted(((d, t or "") for d, t in rows()),
                   key=lambda r: (r[0] is None, -(r[0] or 0), signed(key(r[1]))))
    want, errors = {}, []
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        want.setdefault((d, len(t), hashlib.sha256(edited.encode()).hexdigest()), []).append((t, edited, following))
    assert sorted(map(str, want)) == sorted({str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got})
    assert len(got) == len(order)
    seen = {}
    for r in got:
        t, edited, following = want[(r.doc_id, r.n_chars, r.edited_sha256)][0]
        for text, f in ((t, r.fingerprint), (edited, r.edited_fingerprint)):
            assert len(f) == fp.BINS * fp.BITS // 4
            assert seen.setdefault(text, f) == f  # equal texts, equal fingerprints
        for other, near in ((edited, r.near_edited), (following, r.near_next)):
            assert 0 <= near <= 1
            errors.append(abs(near - overlap(t, other)))
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.16


def test_densified_slots_equal_a_plain_version(spark):
    starts, steps, _ = fp._orders()
    texts = ["", "one", "a b c d e f", " ".join(f"w{i}" for i in range(90)), " ".join(f"v{i * i}" for i in range(700))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(fp.as_hex(fp.fingerprint(df["text"]))).collect()]
    # hashes of (long, int) pairs as Spark chains them
    from pyspark.sql import functions as F

    for text, hexed in zip(texts, got):
        bins = {}
        for s in hashes(text):
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            bins[h >> 56] = min(bins.get(h >> 56, h), h)
        if not bins:
            assert hexed == "0" * 256
            continue
        donors = []
        for b in range(256):
            t = 0 if b in bins else next(t for t in range(256) if (starts[b] + t * steps[b]) % 256 in bins)
            h = bins[b] if b in bins else bins[(starts[b] + t * steps[b]) % 256]
            donors.append((h - (1 << 64) if h >> 63 else h, b))
        mixed = spark.createDataFrame(donors, "h long, b int").select(F.xxhash64("h", "b").alias("m"), "b")
        slots = {r.b: r.m & 15 for r in mixed.collect()}
        assert hexed == "".join(f"{slots[b]:x}" for b in range(256))


def test_single_row_and_empty(spark):
    one = fp.compare(spark.createDataFrame([(5, "a b c d e f g", "", "")], SCHEMA)).collect()
    assert one[0].near_next == 1.0 and one[0].n_chars == 13
    assert fp.compare(spark.createDataFrame([], SCHEMA)).collect() == []
