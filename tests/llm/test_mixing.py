"""Weighted fair queueing against a plain queue."""

import hashlib
import re
from collections import Counter, defaultdict

from quarry.llm import mixing

SCHEMA = "doc_id long, text string, source string, src string, target string"


def key(doc_id, seed=11):
    return int(hashlib.md5(f"{'' if doc_id is None else doc_id}:{seed}".encode()).hexdigest()[:15], 16)


def plain(rows, share=1.5, repeats=2):
    """doc_id -> [(size, source size, target, taken)], by serving one document after the other."""
    docs = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows]
    sums = Counter()
    for _, s, n in docs:
        sums[s] += n
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, target, left = share * sum(sums.values()), {}, set(names)
    while left:
        level = (budget - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] >= repeats * sums[s]}
        if not full:
            break
        target |= {s: float(repeats * sums[s]) for s in full}
        left -= full
    target |= {s: level * weight[s] for s in left}
    queue = []
    for i, s in enumerate(names):
        own = sorted({(key(d), d is not None, d or 0): d for d, t, _ in docs if t == s}.items())
        upto = 0
        for _, d in own:
            upto += sum(n for e, t, n in docs if t == s and e == d)
            for e in range(repeats):
                queue.append(((e * sums[s] + upto) / target[s] if target[s] else 0.0, i, e, s, d))
    spent, taken = 0, defaultdict(int)
    peers = defaultdict(list)
    for v, i, e, s, d in queue:
        peers[v, i].append((s, d))
    for at in sorted(peers):
        size = sum(n for s, d in peers[at] for e, t, n in docs if t == s and e == d)
        if spent + size > budget * (1 + 1e-12) + 1e-6:
            break
        spent += size
        for s, d in peers[at]:
            taken[s, d] += 1
    return sorted(((d, n, sums[s], target[s], n * taken[s, d]) for d, s, n in docs), key=str)


def sample():
    rows = [(i, "w " * (i * 7 % 40), f"s{i % 5}" if i % 2 else "s0") for i in range(200)]
    rows += [(300, None, "s1"), (301, "", None), (302, "a\x85b c", None), (302, "a\x85b c", None), (None, "x y", "s2"),
             (303, "z " * 5000, "big"), (304, "é", "É"), (305, "", "empty source")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(4)


def test_equals_a_plain_queue(spark):
    rows = sample()
    got = []
    for r in mixing.plan(frame(spark, rows)).collect():
        got.append((r.doc_id, r.size, r.source_size, r.target, r.size * sum(r.passes)))
    want = plain(rows)
    got.sort(key=str)
    assert [g[:3] + (round(g[3], 6), g[4]) for g in got] == [w[:3] + (round(w[3], 6), w[4]) for w in want]
    assert 0 < sum(g[4] for g in got) <= 1.5 * sum(g[1] for g in got)


def test_mix_returns_the_copies_of_the_plan(spark):
    docs = frame(spark, sample())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    times = Counter((r.doc_id, r.source) for r in mixed.collect())
    rows = Counter((d, s) for d, _, s in sample())
    planned = {(r.doc_id, None if r.src_null else r.src): sum(r.passes) for r in mixing.plan(docs).collect()}
    assert times == Counter({k: n * rows[k] for k, n in planned.items() if n})


def test_all_sources_full_and_empty_tables(spark):
    docs = frame(spark, [(i, "a b c", "s") for i in range(10)])
    assert all(sum(r.passes) == 2 for r in mixing.plan(docs, share=2.0).collect())
    assert mixing.plan(docs.limit(0)).collect() == [] and mixing.mix(docs.limit(0)).collect() == []
    blank = frame(spark, [(1, "", "s"), (2, None, None)])
    assert [r.target for r in mixing.plan(blank).collect()] == [0.0, 0.0]
