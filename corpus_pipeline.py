"""The corpus pipeline: documents to token ids, in stages of one operator each.

Every stage works on all that the one before it kept. All but the last return the columns of documents. Rows
without a doc_id, or with one that stands in several rows, have defined results: rows of one doc_id stay or go
together where a stage decides on documents, and those without stay.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwatch.llm import bpe, decontaminate, minhash_dedup, quality, substring_dedup
from vaultwatch.llm.common import settle, small_batches, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
RANKS = "byte_bpe_multi_50k.tiktoken"
PASSAGE_WORDS = 51  # a passage of more than 50 words that repeats goes, and one of substring_dedup.LENGTH bytes


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents but those of these ids, which are settled first, so that their size is known to the join."""
    return docs.join(settle(ids.filter("doc_id IS NOT NULL").distinct(), "left-out"), "doc_id", "left_anti").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones; all of them where there is nothing to learn from."""
    small_batches(spark)
    return quality.accept(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id; five words, similarity 0.8."""
    small_batches(spark)
    found = minhash_dedup.link(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return _without(docs, found.filter("NOT kept").select("doc_id"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without passages that stand elsewhere too; a text of nothing else becomes empty and stays."""
    small_batches(spark)
    cleaned = substring_dedup.clean(docs, n_words=PASSAGE_WORDS)
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    small_batches(spark)
    return _without(docs, decontaminate.find(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the SHA-256 of what they decode to."""
    small_batches(spark)
    coded = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", substring_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]
# The classifier and the sketches have no form in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
