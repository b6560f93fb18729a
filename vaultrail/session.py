"""Session settings and shared work folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. All of them may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where its partitioning would have served the next step.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Windows and aggregates over (key, chunk) must spread a key over its chunks. Without this, rows that are already
    # partitioned by the key alone would be left together, and a hot key with them.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # A union of equally partitioned parts may pass for partitioned itself; when the parts are then coalesced one by one at run
    # time, rows of one part are lost (seen in Spark 4.1.2 with a repartition on top of such a union).
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hashing and sealing cost far more per byte than reading, so small partitions are worth a core of their own.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Most of what is stored is hexadecimal or base64 text, in which only an entropy coder finds anything to save.
    "spark.sql.parquet.compression.codec": "zstd",
    # A Python worker holds a few batches at a time, as Python objects; what passes through it are texts and states, not numbers.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above and make sure reliable checkpoints have a folder."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A machine-local folder is used only when the whole session runs in one local JVM.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="vaultrail-")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/vaultrail/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a work folder that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """One split per core for a table that arrives in fewer, as small files do; other tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several sinks, so that it is computed once and stays readable when
    executors are lost.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
