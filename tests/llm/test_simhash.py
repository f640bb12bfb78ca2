"""SimHash near-dedup against brute force."""

import re

import pytest
import xxhash
from pyspark.sql import Row

from quarry.llm import simhash
from quarry.llm.components import components

SCHEMA = "doc_id long, text string, source string, fp string"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def brute(rows, radius=3):
    fps = {d: plain_fingerprint(t) for d, t in rows}
    ids = sorted(fps)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if bin(fps[a] ^ fps[b]).count("1") <= radius]
    return fps, plain_components(ids, linked)


def texts():
    base = " ".join(f"Word{i % 37}x{i}" for i in range(400))
    out = [(i, base.replace(f"x{7 * i + 3} ", f"y{i} ")) for i in range(30)]
    out += [(100 + i, f"short text {i}") for i in range(20)] + [(200, None), (201, ""), (202, " \t\n"), (203, "one")]
    out += [(300 + i, out[i][1]) for i in range(5)] + [(400, "É É É\x85a b"), (401, "z" * 30000), (402, "a b " * 9000)]
    return out


def test_groups_equal_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(d, t, "s", "clash") for d, t in rows], SCHEMA).repartition(5)
    got = simhash.near_groups(docs).collect()
    fps, comp = brute(rows)
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == comp
    assert len(set(comp.values())) < len(rows) - 10  # something is linked


def test_parts_of_a_tile_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 3)
    rows = texts()
    docs = spark.createDataFrame([(d, t, "s", "clash") for d, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
    assert got == brute(rows)[1]


def test_random_links_across_tiles(spark):
    import random

    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(150)}
    for f in list(fps):
        g = f
        for _ in range(rnd.randint(1, 5)):
            g ^= 1 << rnd.randrange(64)
        fps.add(g)
    fps |= {0, 1, 7, 15, (1 << 64) - 1}
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.component for r in components(simhash.links(classes)).collect()}
    ids = sorted(signed)
    mask = (1 << 64) - 1
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if bin((a ^ b) & mask).count("1") <= 3]
    want = plain_components(ids, linked)
    assert {n: got.get(n, n) for n in ids} == want


def test_keep_one_keeps_columns_and_repeated_rows_once(spark):
    rows = [(1, "a b c d", "x", "p"), (2, "a b c d", "y", "q"), (3, "e f g h", "z", "r"), (3, "e f g h", "z", "r"),
            (None, "e f g h", "z", "r"), (None, "only null ids", None, None), (9, None, None, None),
            (None, "a second group without any id", None, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "source", "fp"]
    assert sorted(kept.collect(), key=str) == sorted(
        [Row(*rows[0]), Row(*rows[2]), Row(*rows[5]), Row(*rows[6]), Row(*rows[7])], key=str)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_groups(docs).collect() == []
    assert simhash.keep_one(docs).collect() == []


@pytest.mark.parametrize("chain", [1, 2, 40])
def test_components_of_a_chain_and_a_star(spark, chain):
    pairs = [(i, i + 1) for i in range(chain)] + [(1000, 1000 + i) for i in range(1, 30)] + [(5000, 5000), (7, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(chain + 1)}, **{1000 + i: 1000 for i in range(30)}}
