"""Every stage of the pipeline against a plain version, on what the stage before it kept."""

from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as cp
from quarry.llm import packing, quality

from .test_lines import brute as brute_lines
from .test_lines import near
from .test_simhash import brute as brute_groups
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """name -> (rows before, rows after)"""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        after = cp.saved(stage(spark, docs, SF), "test")
        if name != cp.STAGES[-1][0]:
            assert after.schema.simpleString() == docs.schema.simpleString()
        out[name] = (docs.collect(), after.collect())
        docs = after
    return out


def test_quality_stage(spark, stages):
    before, after = stages["quality_classifier"]
    w, b, _ = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    score = {r.doc_id: 1 / (1 + np.exp(-(quality.features(r.text) @ w + b))) for r in before}
    assert sorted(after) == sorted(r for r in before if score[r.doc_id] >= 0.3)
    assert 0 < len(after) < len(before)


def test_line_stage(stages):
    before, after = stages["line_dedup"]

    want, _ = brute_lines([(r.doc_id, r.text) for r in before], near=near)
    kept = {d: t for d, _, t in want if t.strip()}
    assert {r.doc_id: r.text for r in after} == kept
    assert all(r.n_chars == len(r.text) for r in after)
    rest = {r.doc_id: (r.lang, r.source) for r in before}
    assert all(rest[r.doc_id] == (r.lang, r.source) for r in after)


def test_near_copy_stage(stages):
    before, after = stages["simhash_near_dedup"]
    _, comp = brute_groups([(r.doc_id, r.text) for r in before])
    assert sorted(after) == sorted(r for r in before if comp[r.doc_id] == r.doc_id)


def test_mixing_stage(stages):
    before, after = stages["mix_sources"]
    size = {r.doc_id: len(r.text.encode().split()) for r in before}
    source = {r.doc_id: r.source for r in before}
    times = Counter(r.doc_id for r in after)
    assert set(after) <= set(before) and max(times.values()) == 2
    sums, taken = Counter(), Counter()
    for d in size:
        sums[source[d]] += size[d]
        taken[source[d]] += size[d] * times[d]
    budget, names = 1.5 * sum(sums.values()), sorted(sums)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:  # deal again until no source is above twice its size
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sums[s]}
        if not full:
            break
        target |= {s: 2 * sums[s] for s in full}
        open_ -= full
    target |= {s: level * weight[s] for s in open_}
    longest = defaultdict(int)
    for d in size:
        longest[source[d]] = max(longest[source[d]], size[d])
    assert sum(taken.values()) <= budget + 1e-6
    assert all(abs(taken[s] - target[s]) <= longest[s] + 1e-6 for s in names)


def test_packing_stage(stages):
    before, after = stages["best_fit_packing"]
    docs = [(r.doc_id, r.text) for r in before]
    tokens = sum(r.length for r in after)
    sizes = Counter(r.sequence_id for r in after)
    plain = packing.best_fit([], dict(Counter(r.length for r in after)), 1024)
    assert -(-tokens // 1024) <= len(sizes) <= packing.fitness(plain, 1024)[0]
    copies = Counter(d for d, _ in docs)
    once = [(d, t) for d, t in dict(docs).items() if copies[d] == 1]
    assert len({(r.sequence_id, r.offset) for r in after}) == len(after)
    check = [r for r in after if copies[r.doc_id] == 1]
    have = Counter((r.doc_id, r.piece) for r in after)
    assert all(n == copies[d] for (d, _), n in have.items()) and len(check) > 0 and len(once) > 0


def test_run_equals_its_stages(spark, stages):
    got = cp.run(spark, SF).collect()
    assert sorted(got) == sorted(stages["best_fit_packing"][1])
    check_packing(got, [(r.doc_id, r.text) for r in stages["best_fit_packing"][0]], 1024, 2)


ODD = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "one line that is long enough\none line that is long enough", "en", None, None),
       (3, "one line that is long enough\none line that is long enough", "en", None, None), (3, "another text under the same id", "de", "b", 30),
       (4, "word " * 30_000, "en", "a", 150_000), (5, "\n \n", None, "b", 3)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_and_empty_tables(spark, rows):
    """Nulls in any column, empty and long texts, repeated rows and ids, clashing extra columns, no rows: every stage
    runs, keeps the columns, and gives only rows it was given."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, line string, size long, piece int, fp long"
    docs = spark.createDataFrame([(*r, "clash", 7, 7, 7) for r in rows], schema)
    for name, stage in cp.STAGES:
        after = cp.saved(stage(spark, docs, SF), "test")
        got = after.collect()
        if name == cp.STAGES[-1][0]:
            assert sum(r.length for r in got) >= len(got) >= len(docs.collect())
        else:
            assert after.columns == docs.columns
            assert {(r.doc_id, r.lang, r.source) for r in got} <= {(r.doc_id, r.lang, r.source) for r in docs.collect()}
            assert all((r.line, r.size, r.piece, r.fp) == ("clash", 7, 7, 7) for r in got)
        docs = after
