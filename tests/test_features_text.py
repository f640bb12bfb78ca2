import math

import numpy as np
import pytest
from pyspark.ml.feature import QuantileDiscretizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.operators import features as FE
from quarry.operators import text as TX


def _vec_rows(spark, rows):
    return spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(rows)], ["id", "features"])


def _arrays(df, col):
    return [list(r[0]) for r in df.orderBy("id").select(vector_to_array(col)).collect()]


def test_tokenizers(spark):
    df = spark.createDataFrame([("RED  HEART  ",), ("Two Words",)], "t string")
    toks = [r.tk for r in TX.tokenize(df, "t", "tk").collect()]
    assert toks[0] == ["red", "", "heart"]  # inner empty kept, trailing dropped
    rt = [r.tk for r in TX.regex_tokenize(df, "t", "tk", pattern=" ").collect()]
    assert rt[0] == ["red", "heart"]
    words = [r.tk for r in TX.regex_tokenize(df, "t", "tk", pattern=r"\w+", gaps=False).collect()]
    assert words[1] == ["two", "words"]
    nulls = spark.createDataFrame([("A b",), (None,)], "t string")
    assert [r.tk for r in TX.tokenize(nulls, "t", "tk").collect()] == [["a", "b"], None]
    assert [r.tk for r in TX.regex_tokenize(nulls, "t", "tk").collect()] == [["a", "b"], None]


def test_stop_words_and_ngrams(spark):
    assert {"the", "and", "of"} <= set(TX.default_stop_words("english"))
    df = spark.createDataFrame([(["the", "red", "And", "heart"],), (["one"],)], "tk array<string>")
    kept = [r.k for r in TX.remove_stop_words(df, "tk", "k").collect()]
    assert kept[0] == ["red", "heart"]
    grams = [r.g for r in TX.ngrams(df, "tk", "g", 2).collect()]
    assert grams[0] == ["the red", "red And", "And heart"] and grams[1] == []
    nulls = spark.createDataFrame([(["a", "the"],), (None,)], "tk array<string>")
    assert [r.k for r in TX.remove_stop_words(nulls, "tk", "k").collect()] == [[], None]  # 'a', 'the' are stop words
    assert [r.g for r in TX.ngrams(nulls, "tk", "g", 2).collect()] == [["a the"], None]


def test_count_vectors_vocabulary_order_and_idf(spark):
    df = spark.createDataFrame(
        [(0, ["b", "a", "a"]), (1, ["a", "c", "b"]), (2, ["d", "c"])], "doc_id int, tk array<string>"
    )
    model, out, vocab = TX.count_vectors(df, "tk", "cv", vocab_size=3, min_df=2)
    # counts: a=3 b=2 c=2 (tie broken by term), d has df 1
    assert model.vocabulary == ["a", "b", "c"]
    weighted = TX.tf_idf(out, "cv", "w")
    first = weighted.where("doc_id = 0").select(vector_to_array("w")).first()[0]
    assert first[0] == pytest.approx(2 * math.log(4 / 3))
    assert first[1] == pytest.approx(1 * math.log(4 / 3))
    fast = TX.tf_idf_from_vocabulary(out, "cv", "w2", TX.fit_vocabulary(df, "tk", vocab_size=3, min_df=2))
    for r in fast.join(weighted.select("doc_id", "w"), "doc_id").collect():
        assert r.w2.toArray().tolist() == pytest.approx(r.w.toArray().tolist())


def test_word2vec_document_mean(spark):
    df = spark.createDataFrame([("boats cross this bay slowly".split(),), ("this bay freezes".split(),)], ["t"])
    model, out = TX.word2vec(df, "t", "v", size=3, min_count=0, seed=1)
    vecs = {r.word: np.array(r.vector) for r in model.getVectors().collect()}
    for r in out.collect():
        np.testing.assert_allclose(np.array(r.v), np.mean([vecs[w] for w in r.t], axis=0), atol=1e-6)


def test_bucketize_and_quantiles(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("id"))
    b = FE.bucketize(df, "id", [-3, 4, 7, 30, 80], "b")
    assert [r.b for r in b.orderBy("id").collect()][:8] == [0.0] * 4 + [1.0] * 3 + [2.0]
    with pytest.raises(Exception):
        FE.bucketize(spark.createDataFrame([(95.0,)], "id double"), "id", [-3, 4, 80], "b").collect()
    mine = FE.quantile_splits(df, "id", 5)
    ref = QuantileDiscretizer(numBuckets=5, inputCol="id", outputCol="q", relativeError=0.0).fit(df).getSplits()
    assert mine == ref


def test_scalers(spark):
    df = _vec_rows(spark, [[1.0, 2.0, 5.0], [3.0, -2.0, 5.0]])
    std = _arrays(FE.standard_scale(df, "features", "s"), "s")
    assert std[0][0] == pytest.approx(1.0 / math.sqrt(2.0)) and std[0][2] == 0.0
    mm = _arrays(FE.minmax_scale(df, "features", "s", 2.0, 4.0), "s")
    assert mm[0] == [2.0, 4.0, 3.0] and mm[1] == [4.0, 2.0, 3.0]
    ma = _arrays(FE.maxabs_scale(df, "features", "s"), "s")
    assert ma[1] == [1.0, -1.0, 1.0]
    ep = _arrays(FE.elementwise_product(df, "features", [2, 0.5, -3], "s"), "s")
    assert ep[0] == [2.0, 1.0, -15.0]
    nm = _arrays(FE.normalize(df, "features", "s", p=1.0), "s")
    assert nm[0] == pytest.approx([1 / 8, 2 / 8, 5 / 8])


def test_poly_pca_and_assemble(spark):
    df = _vec_rows(spark, [[2.0, 3.0]])
    assert _arrays(FE.poly_expand(df, "features", "p", 2), "p")[0] == [2.0, 4.0, 3.0, 6.0, 9.0]
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(50, 2)) @ np.array([[2.0, 0.5], [0.0, 0.3]])
    d2 = _vec_rows(spark, pts.tolist())
    model = FE.fit_pca(d2, "features", 2)
    pc = FE.pca_loadings(model)
    for j in range(2):
        assert pc[np.argmax(np.abs(pc[:, j])), j] > 0
    proj = np.array(_arrays(FE.pca_project(d2, "features", model, "p"), "p"))
    np.testing.assert_allclose(proj, pts @ pc, atol=1e-9)
    ints = spark.createDataFrame([(4, 9, -2)], "p int, q int, r int")
    assert FE.assemble(ints, ["p", "q", "r"], "f").first().f.toArray().tolist() == [4.0, 9.0, -2.0]


def test_index_strings_numbers_as_text_and_unindex(spark):
    df = spark.createDataFrame([(v,) for v in [1, 12, 15, 16, 2, 8]], "value1 int")
    model, out = FE.index_strings(df, "value1", "i")
    assert model.labels == ["1", "12", "15", "16", "2", "8"]
    back = FE.unindex(out, "i", "s")
    assert all(r.s == str(r.value1) for r in back.collect())
    _, skipped = FE.index_strings(df, "value1", "i", handle_invalid="skip")
    assert skipped.count() == 6


def test_index_vector_and_one_hot(spark):
    df = spark.createDataFrame(
        [(Vectors.dense(1, 2, 3), 1), (Vectors.dense(2, 5, 6), 2), (Vectors.dense(1, 8, 9), 3)], ["features", "label"]
    )
    out = [list(r.i.toArray()) for r in FE.index_vector(df, "features", "i", 2).collect()]
    assert [o[0] for o in out] == [0.0, 1.0, 0.0] and [o[1] for o in out] == [2.0, 5.0, 8.0]
    idx = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "c double")
    oh = [r.o.toArray().tolist() for r in FE.one_hot(idx, "c", "o").collect()]
    assert oh == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_rformula_levels(spark):
    df = spark.createDataFrame(
        [("good", "red", 1, 1.0), ("bad", "blue", 2, 2.0), ("bad", "red", 3, 3.0), ("good", "green", 4, 4.0)],
        "lab string, color string, value1 long, value2 double",
    )
    _, out = FE.rformula(df, "lab ~ . + color:value1 + color:value2")
    assert len(out.first().features) == 2 + 1 + 1 + 3 + 3


def test_chi2(spark):
    df = spark.createDataFrame(
        [(0.0, Vectors.dense(0.0, 1.0)), (1.0, Vectors.dense(1.0, 1.0)), (1.0, Vectors.dense(1.0, 0.0)),
         (0.0, Vectors.dense(0.0, 0.0))],
        ["label", "features"],
    )
    stats = {r.featureIndex: r.statistic for r in FE.chi2_test(df, "features", "label").collect()}
    assert stats[0] == pytest.approx(4.0) and stats[1] == pytest.approx(0.0)
    sel = FE.chi2_select(df, "features", "label", 1, "sel")
    assert sel.first().sel.size == 1


def test_chi2_with_a_label_per_customer(spark):
    """Equal to MLlib where its contingency columns suffice, and no limit on labels beyond."""
    from pyspark.ml.stat import ChiSquareTest

    rows = [(float(i % 7), Vectors.dense(float(i % 3), float(i * i % 5), 1.0)) for i in range(400)]
    df = spark.createDataFrame(rows, ["label", "features"])
    ours = {r.featureIndex: r for r in FE.chi2_test(df, "features", "label").collect()}
    for r in ChiSquareTest.test(df, "features", "label", flatten=True).collect():
        got = ours[r.featureIndex]
        assert got.degreesOfFreedom == r.degreesOfFreedom
        assert got.statistic == pytest.approx(r.statistic, abs=1e-6)
        assert got.pValue == pytest.approx(r.pValue, abs=1e-6)
    wide = spark.range(30_000).selectExpr("id % 15000 AS label", "array(double(id % 15000 % 2), double(id * 7919 % 30011 % 3)) AS features")
    stats = {r.featureIndex: r for r in FE.chi2_test(wide, "features", "label").collect()}
    assert stats[0].statistic == pytest.approx(30_000) and stats[0].degreesOfFreedom == 14_999 and stats[0].pValue < 1e-9
    assert 0 < stats[1].statistic < 30_000 and stats[1].degreesOfFreedom == 29_998 and stats[1].pValue > 0.01


def test_metrics_of_degenerate_labels(spark):
    from quarry.operators import evaluation as EV

    df = spark.createDataFrame([(0.3, 1.0), (0.6, 1.0)], "rawPrediction double, label double")
    one = EV.binary_metrics(df).first()
    assert one.areaUnderROC is None and one.areaUnderPR == 1.0
    flat = EV.regression_metrics(df.withColumnRenamed("rawPrediction", "prediction")).first()
    assert flat.r2 is None and flat.n == 2


def test_checked_stop_words_are_the_whole_default_list(spark):
    from quarry.plans import q_text

    assert len(q_text.STOP_WORDS) == 181
    assert q_text.STOP_WORDS == TX.default_stop_words("english")
    assert "'don''t'" in q_text._stop_sql() or "don't" not in q_text.STOP_WORDS
    assert "'i''ll'" in q_text._stop_sql()


def test_vocabulary_counts_rows_in_the_same_scan(spark):
    rows = [(0, ["plum", "fig", "fig", None]), (1, ["fig", "plum"]), (2, []), (3, None), (4, ["kiwi"])]
    df = spark.createDataFrame(rows, "k int, tk array<string>")
    vocab = TX.fit_vocabulary(df, "tk", vocab_size=2)
    assert vocab.terms == [("fig", 3, 2), ("plum", 2, 2)] and vocab.n_docs == 5
    assert TX.fit_vocabulary(df, "tk", min_df=0.3).terms == [("fig", 3, 2), ("plum", 2, 2)]
    assert TX.fit_vocabulary(df, "tk", min_df=0.2).terms[-1] == ("kiwi", 1, 1)
    none = TX.fit_vocabulary(df.where("k > 9"), "tk")
    assert none.terms == [] and none.n_docs == 0
    assert [tuple(r) for r in vocab.table(spark).orderBy("index").collect()] == [("fig", 3, 2, 0), ("plum", 2, 2, 1)]


def test_word_vectors_do_not_depend_on_the_input_split(spark):
    words = "tide reef kelp dune gull crab mist foam".split()
    rows = [([words[(i * k + k) % 8] for k in range(1, 3 + i % 5)], i) for i in range(90)]
    df = spark.createDataFrame(rows, "t array<string>, i int")

    splits = df.repartition(2), df.orderBy(F.col("i").desc()).repartition(7), df.coalesce(1)

    def layout(split):
        return [[tuple(r.t) for r in part] for part in TX.sentence_layout(split.select("t"), "t", 3).rdd.glom().collect()]

    def vectors(split):
        model, _ = TX.word2vec(split, "t", "v", size=4, seed=5, num_partitions=1)
        return {r.word: tuple(r.vector) for r in model.getVectors().collect()}

    assert layout(splits[0]) == layout(splits[1]) == layout(splits[2])
    assert vectors(splits[0]) == vectors(splits[1]) == vectors(splits[2])
