"""Property tests (hypothesis) for text, indexing and splits."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import features as FE
from quarry.operators import shaping as P
from quarry.operators import text as TX

WORDS = st.text(alphabet="ab Cé\t\n", max_size=12)


def _java_split_ws(s: str) -> list[str]:
    """String.split("\\s") on a lower-cased string: trailing empty strings removed."""
    parts = re.split(r"[ \t\n\x0b\f\r]", s.lower())
    while parts and parts[-1] == "" and len(parts) > 1:
        parts.pop()
    if parts == [""] and s != "":
        return []
    return parts


@settings(max_examples=10, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=8))
def test_tokenize_and_regex_tokenize(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    tok = {r.i: r.tk for r in TX.tokenize(df, "t", "tk").collect()}
    rtok = {r.i: r.tk for r in TX.regex_tokenize(df, "t", "tk", pattern=r"\s+").collect()}
    for i, t in enumerate(texts):
        assert tok[i] == _java_split_ws(t)
        # gaps with \s+ and empties dropped == the non-empty whitespace tokens
        assert rtok[i] == [w for w in tok[i] if w]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(["x", "y", "z", "10", "9", "2"]), min_size=1, max_size=30))
def test_index_unindex_identity(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    _, idx = FE.index_strings(df, "v", "i")
    back = FE.unindex(idx, "i", "w")
    assert all(r.v == r.w for r in back.collect())
    # most frequent value gets index 0; ties by text
    counts = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    first = sorted(counts, key=lambda v: (-counts[v], v))[0]
    assert {r.v for r in idx.where(F.col("i") == 0).collect()} == {first}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=200, unique=True),
       st.lists(st.integers(1, 5), min_size=2, max_size=4))
def test_split_rows_disjoint_and_complete(spark, keys, weights):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    parts = [set(r.k for r in p.collect()) for p in P.split_rows(df, weights, "k", seed=2)]
    assert set().union(*parts) == set(keys)
    assert sum(len(p) for p in parts) == len(keys)
