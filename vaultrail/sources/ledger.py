"""Ledger tables on any Spark file system."""

from __future__ import annotations

import re
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.functions.crypto import Keyring
from vaultrail.operators import access, ingest, proofs
from vaultrail.session import materialise, remove_folder, work_folder


# Stored columns; the day is the folder.
ROWS = (
    "event_id bigint, created_at timestamp, actor_index string, action_index string, target_index string, tenant_index string, "
    "trace_index string, payload string, logical_clock bigint, is_claim_check boolean, agent_context string, "
    "attestation_proof string, day date"
)
BLOBS = "hash string, blob string"
COUNTS = "accepted bigint, rejected bigint"
# Batch of the rows and blobs that a purge has written anew.
PURGED = "purged"


def read_events(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Audit events with the full event schema; columns a file lacks are null."""
    schema = ",".join(f"{n} {t}" for n, t in ingest.AUDIT_EVENT.items())
    return spark.read.schema(schema).format(file_format).load(path)


def stream_events(spark: SparkSession, path: str, file_format: str = "json", files_per_batch: int = 100) -> DataFrame:
    """The same as a stream of files."""
    schema = ",".join(f"{n} {t}" for n, t in ingest.AUDIT_EVENT.items())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(file_format).load(path)


def ingest_events(
    events: DataFrame,
    path: str,
    keyring: Keyring,
    chunk: list[Column],
    policy: ingest.IngestPolicy = ingest.IngestPolicy(),
    base: Column | None = None,
    letters=None,
    batch: str | None = None,
    put=None,
) -> DataFrame:
    """Audit events into the ledger: guards, sealing, logical clocks, append; returns the counts.

    Events are sealed before anything is written. Only sealed columns and what clocks need are staged.
    ``batch`` and ``put`` are those of :func:`append`.
    """
    guarded = ingest.guard_events(ingest.with_event_columns(events), policy)
    start = F.lit(0) if base is None else base
    sealed = ingest.seal_events(guarded, keyring, policy).withColumn("clock_base", start)
    return append(sealed, path, letters, lambda rows: ingest.assign_clocks(rows, chunk, F.col("clock_base")), batch, put)


def append(sealed: DataFrame, path: str, letters=None, clocks=None, batch: str | None = None, put=None) -> DataFrame:
    """Append sealed events to the ledger below ``path`` as one batch and return accepted and rejected counts.

    The envelope is staged once in the shared folder and split from there, so that sealing runs once although there are
    several outputs; no plaintext column is written, and the stage is removed at the end. Blobs are stored before
    the rows that point to them. Rows are stored by day and sorted by actor index, which lets a search skip row groups; a
    large day is split into several even files. ``clocks`` gives the staged rows their clocks, from their unsealed columns. ``letters`` receives the rejected
    rows with all their columns.

    Blobs and rows of a batch lie in folders of its own, and its counts are written last: they are its commit, and a batch
    without them is no part of the ledger. With a caller's ``batch`` name (letters, digits, ``.``, ``_``, ``-``) an append that has
    died half-way is done again by the same call, and one that is complete returns its counts and writes nothing. Two
    jobs must not write one batch at the same time.

    ``put(hash, sealed text)`` stores blobs elsewhere, from the tasks that hold them; it may be called again for the same blob.
    A blob for which it raises or returns False stays in its row, as if it had been small.
    """
    spark = sealed.sparkSession
    name = uuid.uuid4().hex if batch is None else batch
    if not re.fullmatch(r"[\w.-]+", name, re.ASCII):
        raise ValueError("a batch name has letters, digits, '.', '_' and '-' only")
    done = f"{path}/commits/batch={name}"
    if name in committed(spark, path):
        return spark.read.schema(COUNTS).parquet(done)
    extra = [c for c in ("request_id", "clock_base") if c in sealed.columns]
    folder = work_folder(spark, "sealed")
    sealed.select(*ingest.ENVELOPE, "reject_reason", *extra).write.parquet(folder)
    staged = ingest.staged_rows(spark, folder)
    blobs = ingest.claim_blobs(staged)
    if put is None:
        blobs.write.mode("overwrite").parquet(f"{path}/blobs/batch={name}")
    else:
        ingest.put_blobs(blobs, put).write.parquet(f"{folder}-outcomes")
        staged = ingest.keep_inline(staged, spark.read.parquet(f"{folder}-outcomes"))
    rows = ingest.accepted_rows(staged if clocks is None else ingest.with_clocks(staged, clocks))
    _write_rows(rows.select("*", F.to_date("created_at").alias("day")), f"{path}/rows/batch={name}")
    if letters is not None:
        letters(ingest.rejected_rows(sealed))
    bad = F.col("reject_reason").isNotNull()
    counts = staged.agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    counts.coalesce(1).write.mode("overwrite").parquet(done)
    remove_folder(spark, folder)
    remove_folder(spark, f"{folder}-outcomes")
    return spark.read.schema(COUNTS).parquet(done)


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches whose counts are complete."""
    marks = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/commits/*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(f.getPath().getParent().getName().removeprefix("batch=") for f in found or [])


def _write_rows(rows: DataFrame, folder: str) -> None:
    even = rows.hint("rebalance", "day").sortWithinPartitions("day", "actor_index")
    even.write.mode("overwrite").partitionBy("day").parquet(folder)


def _read(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """Files of all committed batches, and those a snapshot refers to, with the ``_metadata`` of each row's file.

    The plan is a scan of the batches' folders. A snapshot adds one scan for each older ledger whose files it still uses.
    """
    batches = committed(spark, path)
    columns = [c.split()[0] for c in schema.split(", ")]

    def scan(root: str, paths: list[str]) -> DataFrame:
        frame = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        return frame.select(*columns, F.col("_metadata.file_path").alias("_file"))

    root = f"{path}/{kind}"
    # Batches whose blobs are stored elsewhere have no folder of blobs.
    paths = [p for p in (f"{root}/batch={b}" for b in batches) if kind == "rows" or _there(spark, p)]
    scans = [scan(root, paths)] if paths else []
    if PURGED in batches:
        kept: dict[str, list[str]] = {}
        for row in spark.read.parquet(f"{path}/refs").where(F.col("kind") == kind).collect():
            kept.setdefault(row["file"].rpartition("/batch=")[0], []).append(row["file"])
        scans += [scan(r, files) for r, files in sorted(kept.items())]
    empty = spark.createDataFrame([], f"{schema}, _file string")
    return reduce(DataFrame.unionByName, scans) if scans else empty


def _there(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _file_name(uri: str) -> str:
    """One spelling of a file's address, as it may be passed to a reader."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows with the day they are stored under; also of a ledger that holds none."""
    return _read(spark, path, "rows", ROWS).drop("_file")


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """Stored blobs; the same content may have been appended by several batches."""
    return _read(spark, path, "blobs", BLOBS).drop("_file").dropDuplicates(["hash"])


def purge(spark: SparkSession, path: str, snapshot: str, requests: DataFrame, keyring: Keyring, active_only: bool = False) -> DataFrame:
    """Erase what requests ``(actor, max_created_at)`` cover: a new snapshot of the ledger, and the deleted rows per actor.

    Copy on write by file: only files of rows and blobs that hold something to erase are read in full and written anew below
    ``snapshot``; it refers to all others where they are. What is covered is found from the index and time columns alone.
    The lists of files pass through the driver, as they do when a folder is scanned.

    Nothing of the old ledger is touched, so a run that fails loses nothing and can be repeated elsewhere. Once the snapshot is
    in use, :func:`erase_replaced` deletes the old files that hold erased data; the rest of the old folder must stay.
    """
    rows = _read(spark, path, "rows", ROWS)
    # Inline payloads stay behind: the shuffle of this join has pointers only.
    pointer = F.when(F.col("is_claim_check"), F.col("payload")).alias("hash")
    marked = access.mark_purged(rows.select("event_id", "actor_index", "created_at", pointer, "_file"), requests, keyring, active_only)
    covered = materialise(marked.where("purged").select("event_id", "actor_index", "created_at", "hash", "_file"), "purge-covered")
    covered.select("event_id", "actor_index", "created_at").write.mode("errorifexists").parquet(f"{snapshot}/tombstones")
    replaced, kept = _split_files(rows, covered)
    if replaced:
        hit = _read_files(spark, replaced, ROWS)
        stay = access.kept_rows(access.mark_purged(hit, requests, keyring, active_only))
        _write_rows(stay.select(*[c.split()[0] for c in ROWS.split(", ")]), f"{snapshot}/rows/batch={PURGED}")
    else:
        _write_rows(spark.createDataFrame([], ROWS), f"{snapshot}/rows/batch={PURGED}")
    # A blob goes when no row that stays points to it.
    gone = covered.where("hash is not null").select("hash").distinct()
    pointed = _read_files(spark, kept, ROWS).unionByName(spark.read.schema(ROWS).parquet(f"{snapshot}/rows/batch={PURGED}"))
    pointed = pointed.where("is_claim_check").select(F.col("payload").alias("hash"))
    gone = materialise(gone.join(pointed, "hash", "left_anti"), "purge-blobs")
    blobs = _read(spark, path, "blobs", BLOBS)
    worn, whole = _split_files(blobs, blobs.select("hash", "_file").join(gone, "hash", "left_semi"))
    _read_files(spark, worn, BLOBS).join(gone, "hash", "left_anti").write.mode("overwrite").parquet(f"{snapshot}/blobs/batch={PURGED}")
    lists = [("rows", f) for f in kept] + [("blobs", f) for f in whole]
    spark.createDataFrame(lists, "kind string, file string").write.mode("errorifexists").parquet(f"{snapshot}/refs")
    spark.createDataFrame([(f,) for f in replaced + worn], "file string").write.mode("errorifexists").parquet(f"{snapshot}/replaced")
    counts = spark.read.parquet(f"{snapshot}/tombstones").agg((-F.count("*")).alias("accepted"), F.lit(0).cast("bigint").alias("rejected"))
    counts.coalesce(1).write.mode("errorifexists").parquet(f"{snapshot}/commits/batch={PURGED}")
    return access.purge_counts(read_tombstones(spark, snapshot).withColumn("purged", F.lit(True)))


def _split_files(rows: DataFrame, hit: DataFrame) -> tuple[list[str], list[str]]:
    """Files of a scan with and without any of the rows that are hit."""
    touched = {_file_name(r[0]) for r in hit.select("_file").distinct().collect()}
    every = {_file_name(f) for f in rows.inputFiles()}
    return sorted(touched), sorted(every - touched)


def _read_files(spark: SparkSession, files: list[str], schema: str) -> DataFrame:
    """The rows of some files of ledgers; the day comes from their folders."""
    by_root: dict[str, list[str]] = {}
    for f in files:
        by_root.setdefault(f.rpartition("/batch=")[0], []).append(f)
    columns = [c.split()[0] for c in schema.split(", ")]
    scans = [spark.read.schema(schema).option("basePath", root).parquet(*own).select(*columns) for root, own in sorted(by_root.items())]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], schema)


def erase_replaced(spark: SparkSession, snapshot: str) -> int:
    """Delete the files that a purge has written anew into ``snapshot``, and with them what it has erased; returns their number.

    The ledger that was purged can't be read any more after it.
    """
    if PURGED not in committed(spark, snapshot):
        raise ValueError("the purge of this snapshot is not complete")
    files = [r["file"] for r in spark.read.parquet(f"{snapshot}/replaced").collect()]
    for file in files:
        remove_folder(spark, file)
    return len(files)


def read_tombstones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/tombstones")


def write_dead_letters(letters: DataFrame, path: str) -> None:
    """Append dead letters as JSON lines, one folder per UTC day."""
    letters.write.mode("append").partitionBy("dt").json(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("dt date, timestamp string, error string, payload string").json(path)


def write_bundles(pieces: DataFrame, path: str) -> None:
    """Append evidence bundles as gzipped JSON lines, one folder per project.

    A run of any length is one line, written piece by piece as the pieces leave the sort; the writer puts the closing brace
    behind each of them. Runs without project are stored under an empty name.
    """
    # Only the first piece of a bundle begins with a brace.
    line = F.when(F.col("text").startswith("{"), F.concat(F.lit("\n"), F.col("text"))).otherwise(F.col("text"))
    # A folder column that can't be null needs no second sort by the writer, which would not keep the pieces' order.
    rows = pieces.select(F.coalesce(F.col("project_id").cast("string"), F.lit("")).alias("project_id"), "run_id", "piece", line.alias("value"))
    ordered = rows.repartition("run_id").sortWithinPartitions("project_id", "run_id", "piece")
    ordered.select("project_id", "value").write.mode("append").partitionBy("project_id").option("compression", "gzip").option("lineSep", "}").text(path)


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Stored bundles, one row per run."""
    return spark.read.text(path).where("value <> ''").withColumnRenamed("value", "bundle")


def bundle_records(bundles: DataFrame) -> DataFrame:
    """Tool records of stored bundles; arguments and outputs are JSON text again."""
    items = F.from_json(F.get_json_object("bundle", "$.tools"), "array<string>")
    rows = bundles.select(F.get_json_object("bundle", "$.runId").alias("run_id"), F.explode(items).alias("t"))

    def part(name: str):
        return F.get_json_object("t", f"$.{name}")

    return rows.select(
        "run_id",
        part("seq").cast("bigint").alias("seq"),
        part("toolName").alias("tool"),
        part("argsHash").alias("args_hash"),
        part("args").alias("args"),
        part("output").alias("output"),
        part("capturedAt").cast("bigint").alias("captured_at"),
    )


def export_csv(rows: DataFrame, path: str) -> None:
    """Write searched or filtered rows as CSV with a header."""
    rows.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


# --- hash chains -------------------------------------------------------------------------------------------------------

CHAIN = "project_id string, seq bigint, payload_hash string, chain_hash string, commit bigint"
HEADS = "project_id string, seq bigint, chain_hash string, commit bigint"


def append_chain(entries: DataFrame, path: str, commit: int) -> DataFrame:
    """Chain new ledger entries ``(project_id, seq, payload_hash)`` to the stored chains below ``path``; returns the new heads.

    ``commit`` numbers the appends and grows. Only entries beyond the stored heads are folded. The links are written first and
    the heads after them, each as one folder of the commit; links without heads are no part of the chain. An append that is done
    again, or has died half-way, replaces its own folders.
    """
    spark = entries.sparkSession
    own = entries.withColumn("project_id", F.col("project_id").cast("string"))
    earlier = read_heads(spark, path).where(F.col("commit") < commit)
    links = proofs.build_chain(own, proofs.chain_heads(earlier))
    links.write.mode("overwrite").parquet(f"{path}/links/commit={commit}")
    stored = spark.read.schema(CHAIN.rpartition(",")[0]).parquet(f"{path}/links/commit={commit}")
    proofs.chain_heads(stored).write.mode("overwrite").parquet(f"{path}/heads/commit={commit}")
    return read_heads(spark, path).where(F.col("commit") == commit).drop("commit")


def read_heads(spark: SparkSession, path: str) -> DataFrame:
    """Heads that the commits have left, one per commit and project it added to."""
    there = _there(spark, f"{path}/heads")
    return spark.read.schema(HEADS).option("basePath", f"{path}/heads").parquet(f"{path}/heads") if there else spark.createDataFrame([], HEADS)


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Links of all commits that have been completed."""
    links = spark.read.schema(CHAIN).option("basePath", f"{path}/links").parquet(f"{path}/links")
    done = read_heads(spark, path).select("commit").distinct()
    return links.join(done, "commit", "left_semi").drop("commit")
