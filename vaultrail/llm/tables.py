"""Joins with checked sizes, and connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.session import materialise, remove_folder, work_folder

#: Rows up to which a narrow table (a few numbers a row) is sent to every executor.
NARROW_ROWS = 200_000


def small_batches(spark: SparkSession) -> SparkSession:
    """Let texts go to Python in batches of a few megabytes, so that a worker's memory doesn't follow the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only; other columns, whatever their names, go no further."""
    return df.select(*(df[n] for n in names))


def temporary(df: DataFrame, label: str) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` written once to the shared folder, and a function that removes it when nothing reads it any more."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), lambda: remove_folder(spark, path)


def join_narrow(big: DataFrame, narrow: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """Join a wide table with a narrow stored one, whose rows are counted first.

    Up to ``NARROW_ROWS`` rows it is broadcast and the wide table stays where it is; beyond that both are shuffled, with
    skewed partitions split by the adaptive planner.
    """
    return big.join(F.broadcast(narrow) if narrow.count() <= NARROW_ROWS else narrow, on, how)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (u, v): columns node, component.

    Alternates the two star operations of the well-known map-reduce algorithm until the edges no longer change. Each
    round is written to the shared folder, so a lost executor costs one round at most. A node of any degree is
    reduced by a partial minimum; joins on it may be split by the planner.
    """
    work = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = work.unionByName(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.unionByName(low.where("low < u").select("u", F.col("low").alias("v"))).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("low"))
        work = large.join(small, "u")
        work = work.where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(small.select("u", F.col("low").alias("v"))).distinct()
        work = materialise(work, "edges")
        state = work.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            return work.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(work.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state
