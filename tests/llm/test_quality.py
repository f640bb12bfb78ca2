"""Positive-unlabelled quality classifier: held-out accuracy, and what the labels may touch."""

import zlib

import numpy as np
import pytest

from quarry.llm import quality
from quarry.llm import queries as q

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, source string, score string, mark string"


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in q.op7_quality_scores(spark, SF).collect()}


def test_held_out_accuracy(spark, scored):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(scored[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d in labels)
    right = np.mean([scored[d].predicted == labels[d] for d in held])
    good = [scored[d].score for d in held if labels[d] == 1]
    bad = [scored[d].score for d in held if labels[d] == 0]
    assert right >= 0.97
    assert np.mean([g > b for g in good for b in bad]) >= 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored.values())


def test_held_out_labels_are_not_read(spark, scored):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.score(docs.select("doc_id", "text"), quality.train(docs, turned)).collect()
    assert {r.doc_id: r.score for r in other} == {d: r.score for d, r in scored.items()}


def test_non_negative_risk_finds_the_classes():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1.5, 1, (3000, 3)), rng.normal(-1.5, 1, (600, 3))
    w, b = quality.fit(good[:1000], np.vstack([good[1000:], bad]), 2000 / 2600)
    assert np.mean(good @ w + b > 0) > 0.95 and np.mean(bad @ w + b < 0) > 0.9


def test_defined_cases(spark):
    rows = [(1, None, "a", "x", "y"), (1, None, "a", "x", "y"), (None, "", None, None, None), (3, "w " * 60000, "", "", ""),
            (4, "plain words here", "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    none = quality.score(docs, quality.train(docs, labels), "s").collect()
    assert [r.s for r in none] == [0.5] * 5 and none[0].score == "x"
    only_bad = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, quality int")
    assert quality.train(docs, only_bad)[2] == 0.0
    some = spark.createDataFrame([(i, i % 2) for i in (1, 3, 4, None)if i] + [(None, 1)], "doc_id long, quality int")
    kept = quality.keep_good(docs, some, 0.0)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality.keep_good(docs.limit(0), some).collect() == []
