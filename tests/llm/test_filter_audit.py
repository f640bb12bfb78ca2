"""Filter audit against plain counting."""

import random
import re
from itertools import permutations

from quarry.llm import filter_audit as fa

SCHEMA = "doc_id long, lang string, text string, mask string, prefix string"


def plain_mask(rows):
    least = {}
    for d, _, t in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    out = []
    for d, _, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({c for c, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)), d is not None and d > least[t])) if bad})
    return out


def brute(rows, labels):
    fails, out = plain_mask(rows), []
    good = {d for d, quality, _ in labels if quality == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    for part in {r[1] or "" for r in rows}:
        docs = [(d, f) for (d, lang, _), f in zip(rows, fails) if (lang or "") == part]
        steps, totals = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(docs)
            for k, c in enumerate(order, 1):
                gone = [(d, f) for d, f in left if c in f]
                all_failing = sum(c in f for _, f in docs)
                left = [(d, f) for d, f in left if c not in f]
                totals[c] += len(gone)
                steps.append(("".join(order), k, c, len(left), len(gone), all_failing - len(gone), sum(f == {c} for _, f in docs),
                              sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out += [(part, o, k, *rest, totals[c]) for o, k, c, *rest in steps]
    return sorted(out)


def sample():
    rnd = random.Random(4)
    word = lambda: rnd.choice(["Aa", "b", "cé", "D#", "e f", "G", "h" * 30, " ", "i\x85"])
    long = [" ".join(f"w{rnd.randint(0, 400)}" for _ in range(n)) for n in (99, 100, 101, 150, 3000)]
    rows = []
    for i in range(300):
        t = rnd.choice([rnd.choice(long), rnd.choice(long) + rnd.choice([" Q" * 40, " #", ""]), " ".join(word() for _ in range(rnd.randint(0, 120)))])
        rows.append((rnd.randint(0, 400), rnd.choice(["en", "de", None, ""]), t))
    rows += [(500 + i, "en", long[4]) for i in range(80)]
    rows += [(None, "fr", long[1]), (None, "fr", None), (1, "fr", None), (2, "fr", ""), (3, None, "\n \t"), rows[0], rows[0], rows[0]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(6)


LABELS = [(d, d % 3 % 2, d % 7 % 2) for d in range(0, 560, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]


def marks(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def result(spark, rows):
    return sorted(map(tuple, fa.audit(frame(spark, rows), marks(spark)).select(*COLUMNS).collect()))


def test_equals_plain_counting(spark):
    want = brute(sample(), LABELS)
    assert len(want) == 4 * 600 and sum(r[9] for r in want if r[1].endswith("E")) > 0
    assert result(spark, sample()) == want


def test_small_tries_and_prefixes(spark, monkeypatch):
    for name, n in (("PREFIX", 1), ("LONGER", 2), ("SHARES", 5), ("ROWS", 1), ("BYTES", 1)):
        monkeypatch.setattr(fa, name, n)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # few copies meet before the shuffle
    try:
        assert result(spark, sample()) == brute(sample(), LABELS)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_prefixes_are_lengthened_until_light(spark):
    texts = ["the same long beginning of all these texts " + f"{i:04}" * 20 for i in range(500)] + ["other", "the same", ""]
    rows = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    got = [(bytes(r.prefix), len(r.text)) for r in rows.select(fa.adaptive_prefix(rows, 20).alias("prefix"), "text").collect()]
    total, by = sum(n for _, n in got), {}
    for p, n in got:
        by[p] = by.get(p, 0) + n
    assert max(by.values()) <= total / 20 and b"other" in by and b"" in by
    assert not any(a != b and a.startswith(b) for a in by for b in by if b not in (b"", b"the same"))


def test_trie():
    rnd = random.Random(8)
    trie, seen, keys = fa.Trie(), {}, []
    for k in range(2000):
        key, d = bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 7))), rnd.randint(0, 50)
        trie.insert(key, d, k)
        keys.append((key, d))
        seen[key] = min(seen.get(key, d), d)
    assert sorted(trie.copies()) == [k for k, (key, d) in enumerate(keys) if d > seen[key]]


def test_empty(spark):
    assert fa.audit(frame(spark, sample()).limit(0), marks(spark)).collect() == []
    assert len(fa.audit(frame(spark, sample()), marks(spark).limit(0)).collect()) == 2400
