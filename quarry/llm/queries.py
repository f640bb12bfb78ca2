"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import bpe, chat, embeddings, filter_audit, fingerprints, html, lines, merkle, mixing, packing, quality, simhash, suffixes, token_counts
from quarry.llm.common import scratch, table
from quarry.llm.sql import ORACLES

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the wrapper of its host."""
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document; copies are whole."""
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.size(F.filter("passes", lambda p: p))
    return planned.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


#: Vocabulary of the token queries.
VOCABULARY = "byte_bpe_50k.json"


def op3_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), bpe.locator(VOCABULARY))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, through a cache that starts empty (each run must encode the whole table)."""
    counts = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), scratch(spark, "token-cache"), bpe.locator(VOCABULARY)
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op6_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector among those of its label, cosine 0.98."""
    return embeddings.near_groups(table(spark, sf_dir, "embeddings"))


def op7_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of conversation -7, read back from its examples."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat.digest(chat.expand(turns.unionByName(planted)))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay, and how many lines it had and lost."""
    rows, names = lines.with_kept_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", F.col(names["lines"]).alias("n_lines"), F.col(names["dropped"]).alias("n_dropped"),
        F.coalesce(names["kept"], F.lit("")).alias("text"),
    )


def op10_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: three-word shingles, three bits."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to documents of smaller id: strings of 50 bytes."""
    return suffixes.removed_spans(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, per lang, in all 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf, proof and root, and the root that its text leads to after tampering."""
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the whole table."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, QueryFn] = {
    f.__name__: f
    for f in (op1_extract_html, op2_mix_sources, op3_pack_best_fit, op4_token_counts, op5_document_fingerprints, op6_embedding_groups,
              op7_quality_scores, op8_chat_prefix_targets, op9_line_dedup, op10_simhash_groups, op11_suffix_dedup, op12_filter_audit, op13_merkle_manifest, pipeline)
}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of the queries that SQL can express."""
    own = corpus_pipeline.ORACLE_SQL
    return {**ORACLES, **({"pipeline": own} if own else {})}
