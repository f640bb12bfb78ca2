"""Suffix-array dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from quarry.llm import queries as q
from quarry.llm import suffixes

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_chars int, h1 string, first string"


def brute(rows, least=50):
    """doc_id, bytes, removed bytes, spans and digest, by a dictionary of all strings of ``least`` bytes."""
    data = [(float("-inf") if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in data:
        for i in range(len(t) - least + 1):
            first[t[i:i + least]] = min(first.get(t[i:i + least], d), d)
    out = []
    for (d, _), (order, t) in zip(rows, data):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - least + 1):
            if first[t[i:i + least]] < order:
                gone[i:i + least] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def sample():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdé\x00") for _ in range(rnd.randint(1, 6)))
    passage = [" ".join(word() for _ in range(n)) for n in (12, 15, 30, 80, 200)]
    rows = []
    for i in range(150):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 20)))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passage)
            a = rnd.randint(0, len(p) // 2)
            parts += [p[a:rnd.randint(a, len(p))], word()]
        rows.append((rnd.choice([i, i, 1000 - i, 7]), "".join(parts)))
    rows += [(2000 + i, rows[i % 20][1]) for i in range(60)]  # copies
    rows += [(3000, None), (3001, ""), (3002, "é" * 24), (3003, "é" * 25), (3004, "é" * 25), (3005, "a" * 49), (3006, "a" * 49),
             (None, passage[3]), (None, passage[3]), (3100, "ab" * 400), (3099, "ab" * 60), (3101, "x" + "ab" * 40), rows[0], rows[0],
             (3200, passage[4] * 3), (3201, "\n".join(passage))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "clash", "clash") for d, t in rows], SCHEMA).repartition(5)


def result(spark, rows, **settings):
    return sorted(map(tuple, suffixes.removed_spans(frame(spark, rows), **settings).collect()), key=str)


def test_equals_brute_force(spark):
    rows = sample()
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) > 100 and sum(r[3] > 1 for r in want) > 10
    assert result(spark, rows) == sorted(want, key=str)


@pytest.mark.parametrize("hot", [1, 5])
def test_hot_anchors_give_the_same(spark, hot):
    rows = sample()
    assert result(spark, rows, hot=hot) == sorted(brute(rows), key=str)


def test_other_lengths(spark):
    rows = sample()
    assert result(spark, rows, least=30, gram=9) == sorted(brute(rows, 30), key=str)
    assert result(spark, rows, least=64, gram=64) == sorted(brute(rows, 64), key=str)
    with pytest.raises(ValueError):
        suffixes.removed_spans(frame(spark, rows), least=20, gram=30)


def test_long_texts_in_blocks_and_small_slices(spark, monkeypatch):
    for name, n in (("BLOCK", 40), ("SLICE", 300), ("ANCHORS", 7), ("AROUNDS", 9), ("CHUNK", 11)):
        monkeypatch.setattr(suffixes, name, n)
    rows = sample()[::2]
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_longest_previous_factors():
    rnd = random.Random(3)
    for n, letters in ((1, "ab"), (40, "ab"), (300, "abc"), (300, "a")):
        rows = ["".join(rnd.choice(letters) for _ in range(8)) for _ in range(n)]
        values = [rnd.randint(0, 9) for _ in range(n)]
        got = suffixes.previous_factors(np.array([list(r.encode()) for r in rows], np.uint8), np.array(values))
        common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), 8)
        want = [max((common(a, b) for b, w in zip(rows, values) if w < v), default=0) for a, v in zip(rows, values)]
        assert got.tolist() == want


def test_query_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = q.op11_suffix_dedup(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute([(r.doc_id, r.text) for r in docs]))


def test_dedup_keeps_columns(spark):
    line = "a sentence of more than fifty bytes that two documents have in common"
    line += " é"
    rows = [(1, f"first. {line}"), (2, f"{line} second."), (3, None), (4, "short")]
    got = suffixes.dedup(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "n_chars", "h1", "first"]
    assert sorted(map(tuple, got.collect())) == [
        (1, f"first. {line}", 7 + len(line), "clash", "clash"), (2, " second.", 8, "clash", "clash"),
        (3, None, 0, "clash", "clash"), (4, "short", 5, "clash", "clash")]
    assert suffixes.dedup(frame(spark, rows).limit(0)).collect() == []
    assert suffixes.removed_spans(frame(spark, rows).limit(0)).collect() == []
