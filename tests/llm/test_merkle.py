"""Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest

from quarry.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, kids string, at string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def fold(nodes, fan=16):
    """Levels of a tree, and for each node of the lowest level the siblings left and right per level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            lo = i // fan * fan
            paths[k].append((nodes[lo:i], nodes[i + 1:lo + fan]))
            at[k] = i // fan
        nodes = [digest(*nodes[i:i + fan]) for i in range(0, len(nodes), fan)]
    return nodes[0], paths


def brute(rows):
    lower = str.maketrans(merkle._UPPER, merkle._LOWER)
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [fold([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names]
    root, above = fold([t[0] for t in trees])
    out = []
    for s, (sub, paths), up in zip(names, trees, above):
        for (_, _, leaf, r), path in zip(sorted(by[s], key=lambda x: x[:3]), paths):
            change = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            now = plain_leaf((*r[:4], r[4].translate(lower))) if change else leaf
            for left, right in path + up:
                now = digest(*left, now, *right)
            out.append((r[0], leaf, sub, root, digest(*[x for a, b in path + up for x in a + b]), now, now == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(5)


def result(spark, rows):
    return sorted(map(tuple, merkle.manifest(frame(spark, rows), merkle.tampered()).collect()), key=str)


def sample(sizes, seed=1):
    rnd, rows = random.Random(seed), []
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((rnd.randint(0, 5000), s, rnd.choice(["en", None]), rnd.choice([3, None]),
                         rnd.choice(["Ab", "ab", "É Z", None, "", "x" * 5000 + "Q"])))
    return rows


def test_equals_a_plain_tree(spark):
    rows = sample({"a": 700, "b": 17, "c": 1, None: 16, "": 2, "é": 257, "z": 1, **{f"s{i}": 3 for i in range(20)}})
    rows += [(None, "a", "en", 1, "Null Id"), (None, "a", "en", 1, "Null Id"), (None, None, None, None, None)] + [rows[0]] * 20
    want = brute(rows)
    assert {r[6] for r in want} == {True, False}
    assert result(spark, rows) == sorted(want, key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2}, {"a": 16}, {"a": 17}, {None: 1, "a": 1}, {"a": 300}, {f"s{i:03}": 1 for i in range(40)}])
def test_small_trees(spark, sizes):
    rows = sample(sizes, len(sizes))
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_copies_of_upper_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SHARE", 2)
    rows = sample({"a": 900, "b": 300, "c": 40})
    assert result(spark, rows) == sorted(brute(rows), key=str)
    made = merkle.build(frame(spark, rows))
    linked = made.nodes.collect()
    assert {r["parent"] for r in linked} - {r["id"] for r in linked} == {made.root[0]}


def test_empty_and_unchanged(spark):
    rows = sample({"a": 20, "b": 3})
    assert result(spark, rows[:1]) and merkle.manifest(frame(spark, rows).limit(0)).collect() == []
    assert all(r.verified for r in merkle.manifest(frame(spark, rows)).collect())
