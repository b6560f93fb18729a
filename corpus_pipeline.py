"""A training corpus from ``documents``: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vaultrail.llm import mixing, ngram_join, packing, suffix_dedup, toxicity
from vaultrail.llm.tables import small_batches
from vaultrail.session import configure, materialise

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose noisy-or score is 0.3 or more; learned from the labels of the documents given.

    A null or empty text scores 0 and stays; rows without doc_id or label and repeated rows are scored as any other.
    """
    small_batches(configure(spark))
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxic_rows(docs, model, 0.3)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest doc_id, of each component of near duplicates (five words, 0.8).

    Texts decide, not ids: unrelated texts under one doc_id all stay, equal rows leave one, with or without doc_id. Documents
    without words (null and empty texts) are in no group and stay.
    """
    small_batches(configure(spark))
    return ngram_join.one_of_each(docs, size=5, percent=80)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur more than once; all documents stay, null texts as null."""
    small_batches(configure(spark))
    return suffix_dedup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them; null and blank texts have no words and are not taken."""
    configure(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of at most 2048 tokens; a null or empty text is one piece with the end id alone."""
    small_batches(configure(spark))
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=0, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("suffix_dedup", drop_repeated_strings),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
