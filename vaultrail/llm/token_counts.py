"""Token counts through a cache keyed by digests of the normalised content and of the tokenizer's version.

Texts are looked up in the stored counts; each distinct text that is missing is encoded once and its count is appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.llm.tables import pick
from vaultrail.llm.tokens import encoder
from vaultrail.session import materialise

CACHE = "content binary, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of the way it is used."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + b"\0no added special tokens").hexdigest()


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts; none if the folder has none yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(CACHE).parquet(folder) if there else spark.createDataFrame([], CACHE)


def _counted(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield pd.DataFrame({"content": frame["content"], "n_tokens": [len(r) // 4 for r in encoder(path).raws(frame["text"].tolist())]})

    return run


def token_counts(documents: DataFrame, path: str, cache: str, normalise: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8, of the text as it is), n_tokens (of the normalised text).

    ``path`` is a tokenizer file, ``cache`` a folder that all executors reach; equal texts, repeated rows among them, are
    encoded once. ``normalise`` is the identity unless given. A null text counts as empty, with 0 bytes and 0
    tokens. Rows without doc_id are kept; other columns are ignored. Rows of the cache that stand twice, after two runs at once
    or a repeated one, agree, and one of them is used.
    """
    spark = documents.sparkSession
    version = tokenizer_version(path)
    text = normalise(F.coalesce(documents["text"], F.lit("")))
    rows = pick(documents, "doc_id", "text").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    rows = rows.withColumn("content", F.unhex(F.sha2("text", 256)))
    stored = read_cache(spark, cache).where(F.col("tokenizer") == version).select("content", "n_tokens")
    distinct = rows.select("content", "text").dropDuplicates(["content"])
    # Texts already counted go no further than their digests.
    missing = distinct.join(stored.select("content"), "content", "left_anti")
    counts = missing.mapInPandas(_counted(path), "content binary, n_tokens long")
    new = materialise(counts.withColumn("tokenizer", F.lit(version)).select("content", "tokenizer", "n_tokens"), "token-misses")
    new.write.mode("append").parquet(cache)
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))
    return rows.drop("text").join(known, "content", "left").select("doc_id", "n_bytes", "n_tokens")
