"""Token counts through a digest cache.

The cache is a Parquet table, one folder per tokenizer version (the SHA-256 of
its file), with one row per normalised content digest: its token count.
Counting joins the documents' digests to it, encodes each distinct missing
text once, appends the new counts and answers from the cache.  Byte-level
vocabularies tell any two texts apart, so ``normalise`` leaves texts as they
are unless another one is given.

Defined cases: null text is empty (no tokens); repeated texts share a row of
the cache; an empty table adds nothing; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.bpe import encoder
from quarry.llm.common import BROADCAST_ROWS, saved, whole_text

CACHE_SCHEMA = "digest binary, n_tokens long"
#: Texts encoded at once.
TEXTS = 256


def version(path: str) -> str:
    """Digest of a tokenizer file; another file is another version."""
    import hashlib

    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def cached_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts of one tokenizer version; the first call makes an empty table."""
    spark.createDataFrame([], CACHE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(CACHE_SCHEMA).parquet(folder)


def _encode(texts: DataFrame, locate: Callable[[], str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(locate())
        for batch in batches:
            for k in range(0, len(batch), TEXTS):
                some = batch.slice(k, TEXTS)
                counts = [len(b) // 4 for b in own.ids(some.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [some.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
                )
        own.rest()

    return texts.mapInArrow(run, CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame, cache: str, locate: Callable[[], str], normalise: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document.  ``cache`` is the folder
    of the cache, ``locate`` gives the tokenizer file's place (here and in tasks)."""
    spark = docs.sparkSession
    folder = f"{cache}/tokenizer={version(locate())}"
    text = normalise(whole_text())
    digest = F.unhex(F.sha2(text, 256))
    asked = saved(
        docs.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), digest.alias("digest")),
        "digests",
    )
    known = cached_counts(spark, folder)
    missing = saved(asked.select("digest").distinct().join(known, "digest", "left_anti"), "missing")
    texts = docs.select(digest.alias("digest"), text.alias("text"))
    n = missing.count()
    if n:
        # one text of each digest; copies are dropped before the shuffle
        if n <= BROADCAST_ROWS:  # few: the other texts stay where they are
            texts = texts.join(F.broadcast(missing), "digest", "left_semi")
            texts = texts.groupBy("digest").agg(F.first("text").alias("text"))
        else:
            texts = texts.groupBy("digest").agg(F.first("text").alias("text")).join(missing, "digest", "left_semi")
        _encode(texts, locate).write.mode("append").parquet(folder)
    # two runs may have stored the same digest
    counts = saved(spark.read.schema(CACHE_SCHEMA).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return asked.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
