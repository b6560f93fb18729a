"""Stream jobs.

Jobs that need more than Spark's own stateful operators keep their state as tables in the shared folder, one folder per
micro-batch, written in overwrite mode. A micro-batch that is repeated after a failure reads the same earlier folders
and replaces its own, so every output is written exactly once. The work inside a micro-batch is a distributed batch
job, so one very busy scope or run does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from vaultrail.functions.crypto import Keyring
from vaultrail.operators import agents, ingest
from vaultrail.operators.ordered import int_chunk, logical_clock, number_rows
from vaultrail.session import materialise, remove_folder, work_folder

# Micro-batches after which the clock deltas are folded into one snapshot.
SNAPSHOT_EVERY = 64


def run_batches(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``work``; by default it ends when the input is read."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _batch_folder(path: str, table: str, batch: int) -> str:
    return f"{path}/{table}/batch={batch}"


def replace_batch(df: DataFrame, path: str, table: str, batch: int, partition_by: list[str] | None = None) -> None:
    """Write what a micro-batch adds to a table, in place of what an earlier try of it has left."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(_batch_folder(path, table, batch))


def _earlier(spark: SparkSession, path: str, table: str, first: int, batch: int, schema: str) -> DataFrame:
    """Rows micro-batches ``first`` to ``batch - 1`` left in a state table."""
    folders = [_batch_folder(path, table, b) for b in range(first, batch)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


# --- logical clocks --------------------------------------------------------------------------------------------------

_CLOCKS = "request_id string, clock bigint"


def _clock_bases(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """Latest clock of every scope before a micro-batch.

    A clock never falls, so the latest one is the maximum over the deltas. At every ``SNAPSHOT_EVERY``-th batch the
    deltas so far are folded into a snapshot, which bounds what later batches read.
    """
    start = batch // SNAPSHOT_EVERY * SNAPSHOT_EVERY

    def known(snapshot: int, upto: int) -> DataFrame:
        rows = _earlier(spark, path, "clock_deltas", snapshot, upto, _CLOCKS)
        if snapshot > 0:
            rows = rows.unionByName(spark.read.schema(_CLOCKS).parquet(_batch_folder(path, "clock_snapshots", snapshot)))
        return rows.groupBy("request_id").agg(F.max("clock").alias("clock"))

    if batch == start and batch > 0:
        replace_batch(known(start - SNAPSHOT_EVERY, start), path, "clock_snapshots", start)
    return known(start, batch)


def clock_batch(events: DataFrame, path: str, batch: int, chunk: list[Column] | None = None) -> DataFrame:
    """Clocks of one micro-batch, continuing those of earlier batches; rejected rows do not tick.

    ``events(event_id, request_id, logical_clock, ...)`` with an optional ``clock_base`` for scopes that are new.
    """
    spark = events.sparkSession
    bases = _clock_bases(spark, path, batch).withColumnRenamed("clock", "_before")
    own = F.col("clock_base") if "clock_base" in events.columns else F.lit(0)
    based = events.join(bases, "request_id", "left").withColumn("_start", F.coalesce("_before", own))
    chunk = chunk or [int_chunk("event_id")]
    return logical_clock(based, ["request_id"], ["event_id"], chunk, F.col("logical_clock"), F.col("_start")).drop("_before", "_start")


def clock_stream(stream: DataFrame, path: str, chunk: list[Column] | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Logical clocks over a stream, to ``path/clocked``."""

    def work(events: DataFrame, batch: int) -> None:
        replace_batch(clock_batch(events, path, batch, chunk), path, "clocked", batch)
        done = events.sparkSession.read.parquet(_batch_folder(path, "clocked", batch))
        deltas = done.groupBy("request_id").agg(F.max("logical_clock").alias("clock"))
        replace_batch(deltas, path, "clock_deltas", batch)

    return run_batches(stream, work, f"{path}/_progress", trigger)


# --- ingestion -------------------------------------------------------------------------------------------------------


def ingest_stream(
    stream: DataFrame,
    path: str,
    keyring: Keyring,
    policy: ingest.IngestPolicy = ingest.IngestPolicy(),
    trigger: dict | None = None,
    letters: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Seal a stream of audit events into ``rows``, ``blobs``, ``letters`` and ``counts`` below ``path``.

    Each micro-batch is one flush; its size is set on the source (files per trigger) and its pace by the trigger. Events
    are sealed before anything is written; the stage holds sealed columns only and is removed at the end of the flush.
    Blobs are stored before the rows that point to them. Events outside any request share one clock.

    A rejected event becomes a dead letter with all its fields, so that it can be sent again. ``letters`` takes the
    rejected rows and the batch number instead; it may be called again for a batch that is repeated.
    """

    def work(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        guarded = ingest.guard_events(ingest.with_event_columns(events), policy)
        sealed = ingest.seal_events(guarded, keyring, policy)
        folder = work_folder(spark, "flush")
        sealed.select(*ingest.ENVELOPE, "reject_reason", clock_scope().alias("request_id")).write.parquet(folder)
        store_sealed(ingest.staged_rows(spark, folder), path, batch)
        rejected = guarded.where(F.col("reject_reason").isNotNull())
        if letters is None:
            replace_batch(ingest.dead_letters(rejected, letter_text(), F.col("reject_reason"), F.col("created_at")), path, "letters", batch, ["dt"])
        else:
            letters(rejected, batch)
        remove_folder(spark, folder)

    return run_batches(stream, work, f"{path}/_progress", trigger)


def clock_scope() -> Column:
    """Scope of an event's clock; events outside any request share one."""
    return F.coalesce(F.concat(F.lit("r:"), F.col("request_id").cast("string")), F.lit("none"))


def letter_text() -> Column:
    """A rejected event with all its fields."""
    return F.to_json(F.struct(*ingest.AUDIT_EVENT))


def store_sealed(staged: DataFrame, path: str, batch: int) -> None:
    """Blobs, rows with their clocks, and counts of a stored micro-batch of sealed events (rejected ones among them), as ``ingest.staged_rows`` reads it."""
    bad = F.col("reject_reason").isNotNull()
    replace_batch(ingest.claim_blobs(staged), path, "blobs", batch)
    clocks = lambda rows: clock_batch(rows, path, batch)
    replace_batch(ingest.accepted_rows(ingest.with_clocks(staged.where(~bad), clocks)), path, "rows", batch)
    # Clocks need three narrow columns of the stage, which is less to compute again than to write.
    deltas = clocks(staged.where(~bad).drop(*ingest.SEALED)).groupBy("request_id").agg(F.max("logical_clock").alias("clock"))
    replace_batch(deltas, path, "clock_deltas", batch)
    counts = staged.agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    replace_batch(counts, path, "counts", batch)


def drop_repeats(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop events delivered again within the delay; state older than that is dropped."""
    return stream.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["event_id"])


# --- tool runs -------------------------------------------------------------------------------------------------------


def pair_stream(starts: DataFrame, ends: DataFrame, bound: str = "1 hour") -> DataFrame:
    """Completed tool runs from a stream of starts and one of ends or errors.

    ``starts(run_id, tool, input, started_at)``, ``ends(run_id, phase, output, error, ended_at)``; a run id names one
    tool call. A run that does not end within the bound is dropped from the state.
    """
    left = starts.withWatermark("started_at", bound)
    right = ends.withColumnRenamed("run_id", "_run").withWatermark("ended_at", bound)
    in_time = F.expr(f"_run = run_id AND ended_at >= started_at AND ended_at <= started_at + INTERVAL {bound}")
    failed = F.col("phase") == "error"
    return left.join(right, in_time, "inner").select(
        "run_id",
        agents.tool_name("tool").alias("tool"),
        "input",
        (~failed).alias("success"),
        F.when(failed, F.col("error")).otherwise(F.col("output")).alias("result"),
        (F.unix_millis("ended_at") - F.unix_millis("started_at")).alias("latency_ms"),
    )


_RECORDS = (
    "run_id string, call_id bigint, tool string, args_hash string, args string, output string, "
    "latency_ms bigint, captured_at bigint"
)


_RUNS = (
    "run_id string, project_id string, system_prompt string, committed_at bigint, part bigint, n_records bigint, "
    "payload_hash string, previous_hash string, closed bigint"
)

# Micro-batches after which the log of records is cut down to those that are in no bundle yet.
COMPACT_EVERY = 32


def _logged(spark: SparkSession, path: str, table: str, schema: str, batch: int, compact: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What micro-batches before ``batch`` have added to a table: a compacted part and the parts since then.

    A micro-batch writes what it adds and nothing else. Every ``COMPACT_EVERY``-th one first writes ``compact`` of all that is
    known, which bounds what later ones read.
    """
    start = batch // COMPACT_EVERY * COMPACT_EVERY

    def known(base: int, upto: int) -> DataFrame:
        rows = _earlier(spark, path, table, base, upto, schema)
        return rows.unionByName(spark.read.schema(schema).parquet(_batch_folder(path, f"{table}_compacted", base))) if base else rows

    if batch == start and batch:
        replace_batch(compact(known(start - COMPACT_EVERY, start)), path, f"{table}_compacted", start)
    return known(start, batch)


def _latest(runs: DataFrame) -> DataFrame:
    """Last bundle of each run."""
    names = [part.split()[0] for part in _RUNS.split(", ")]
    return runs.groupBy("run_id").agg(F.max_by(F.struct(*names), "part").alias("r")).select("r.*")


def _unbundled(records: DataFrame, latest: DataFrame) -> DataFrame:
    """Records that have arrived after the last bundle of their run."""
    last = latest.select("run_id", F.col("closed").alias("_closed"))
    return records.join(last, "run_id", "left").where("_closed is null or arrived > _closed").drop("_closed")


def bundle_stream(stream: DataFrame, path: str, chunk: Callable[[], list[Column]], trigger: dict | None = None) -> StreamingQuery:
    """Collect tool records until a run's commit row arrives, then write the text of its bundle to ``path/pieces``.

    ``stream`` rows have ``kind`` ``record`` or ``commit``; records carry the tool record columns, commits
    ``project_id``, ``system_prompt`` and ``committed_at``. ``path/runs`` has a row per bundle: its run and part, the number of
    records of the run so far, its digest and that of the part before. Records that arrive after their run's commit make
    a further part in their own micro-batch, which continues ``seq`` and names the digest it follows; a second commit of a run
    changes nothing. :func:`stored_bundles` reads the bundles.

    A micro-batch writes its records, and the bundles it closes; records of open runs are not written again but for a compaction.
    """

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        schema = f"{_RECORDS}, arrived bigint"
        names = [part.split()[0] for part in _RECORDS.split(", ")]
        fresh = rows.where(F.col("kind") == "record").select(*names, F.lit(batch).cast("bigint").alias("arrived"))
        replace_batch(fresh, path, "records", batch)
        fresh = _earlier(spark, path, "records", batch, batch + 1, schema)
        latest = materialise(_latest(_logged(spark, path, "runs", _RUNS, batch, _latest)), "latest-runs")
        body = F.struct("project_id", "system_prompt", "committed_at")
        commits = rows.where(F.col("kind") == "commit").groupBy("run_id").agg(F.max_by(body, "committed_at").alias("c")).select("run_id", "c.*")
        new = commits.join(latest.select("run_id"), "run_id", "left_anti")
        late = latest.join(fresh.select("run_id"), "run_id", "left_semi")
        none = F.lit(None).cast("string")
        closing = new.select("*", F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("before"), none.alias("previous_hash")).unionByName(
            late.select("run_id", "project_id", "system_prompt", "committed_at", (F.col("part") + 1).alias("part"), F.col("n_records").alias("before"), F.col("payload_hash").alias("previous_hash"))
        )
        closing = materialise(closing, "closing-runs")
        logged = _logged(spark, path, "records", schema, batch, lambda records: _unbundled(records, latest)).unionByName(fresh)
        closed = _unbundled(logged.join(closing.select("run_id"), "run_id", "left_semi"), latest)
        numbered = number_rows(closed, ["run_id"], ["call_id"], chunk(), "seq").join(closing.select("run_id", "before"), "run_id")
        numbered = numbered.withColumn("seq", F.col("seq") + F.col("before")).drop("before")
        pieces = agents.evidence_pieces(numbered, closing.drop("part", "before", "previous_hash"))
        replace_batch(pieces.join(closing.select("run_id", "part"), "run_id"), path, "pieces", batch)
        written = spark.read.parquet(_batch_folder(path, "pieces", batch))
        counts = closed.groupBy("run_id").agg(F.count("*").alias("n"))
        digests = agents.bundle_digests(written).select("run_id", "payload_hash")
        done = closing.join(digests, "run_id").join(counts, "run_id", "left").withColumns({"n_records": F.col("before") + F.coalesce("n", F.lit(0)), "closed": F.lit(batch).cast("bigint")})
        replace_batch(done.select([part.split()[0] for part in _RUNS.split(", ")]), path, "runs", batch)

    return run_batches(stream, work, f"{path}/_progress", trigger)


def stored_bundles(spark: SparkSession, path: str) -> DataFrame:
    """``(run_id, part, bundle, payload_hash, previous_hash)`` of a bundle stream, one row per part."""
    pieces = spark.read.parquet(f"{path}/pieces").withColumn("run_id", F.struct("run_id", "part"))
    runs = spark.read.schema(f"{_RUNS}, batch int").option("basePath", f"{path}/runs").parquet(f"{path}/runs").select("run_id", "part", "previous_hash")
    return agents.whole_bundles(pieces).select("run_id.run_id", "run_id.part", "bundle", "payload_hash").join(runs, ["run_id", "part"])


def dead_letter_stream(stream: DataFrame, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Dead letters ``(dt, timestamp, error, payload)`` as JSON lines by UTC day below ``path/letters``."""
    writer = stream.writeStream.format("json").partitionBy("dt").option("path", f"{path}/letters")
    return writer.option("checkpointLocation", f"{path}/_progress").trigger(**(trigger or {"availableNow": True})).start()
