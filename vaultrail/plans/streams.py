"""Stream jobs run to the end of their input; each must equal its batch twin."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.operators import agents, ingest, search
from vaultrail.operators.ordered import int_chunk
from vaultrail.plans import evidence, inputs
from vaultrail.plans.inputs import KEYRING
from vaultrail.plans.oracle import AUDIT, IDENTITIES, PAYLOAD, with_
from vaultrail.plans.registry import registrar
from vaultrail.session import configure, work_folder
from vaultrail.streaming import buffer, jobs

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)

SLICES = 3


def streamed(df: DataFrame, order: str, label: str, slices: int = SLICES) -> DataFrame:
    """A file stream over a table, delivered in ``slices`` consecutive ranges of an integer column.

    Each slice is one file per core, and a micro-batch takes as many files.
    """
    spark = df.sparkSession
    path, files = work_folder(spark, label), spark.sparkContext.defaultParallelism
    low, high = df.agg(F.min(order), F.max(order)).first()
    width = (high - low) // slices + 1
    for i in range(slices):
        part = df.where((F.col(order) >= low + i * width) & (F.col(order) < low + (i + 1) * width))
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def run(query) -> None:
    query.awaitTermination()


@contextmanager
def state_partitions(spark: SparkSession):
    """One state partition per core for a stateful query in a local session; a cluster keeps its own setting.

    The number is fixed when a stateful query first starts, so the planner cannot reduce it later.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stateful stream into a table and read it back."""
    spark = stream.sparkSession
    path = work_folder(spark, label)
    writer = stream.writeStream.format("parquet").option("path", f"{path}/rows")
    with state_partitions(spark):
        run(writer.option("checkpointLocation", f"{path}/_progress").trigger(availableNow=True).start())
    return spark.read.parquet(f"{path}/rows")


@query(
    with_(AUDIT, IDENTITIES)
    + f"SELECT event_id, {PAYLOAD} AS opened FROM ids WHERE event_id % 101 <> 0"
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Sealed rows of a stream, opened again; invalid events are left out."""
    configure(spark)
    events = inputs.audit(spark, folder).withColumn("action", F.when(F.col("event_id") % 101 != 0, F.col("action")))
    path = work_folder(spark, "ingest")
    run(jobs.ingest_stream(streamed(events, "event_id", "events"), path, KEYRING))
    return search.open_ledger(spark.read.parquet(f"{path}/rows"), KEYRING).select("event_id", "opened")


@query(
    with_(AUDIT)
    + """SELECT count(*) FILTER (event_id % 101 <> 0) AS accepted, count(*) FILTER (event_id % 101 = 0) AS rejected,
      count(*) FILTER (event_id % 101 = 0) AS letters FROM audit"""
)
def stream_accounting(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and dead letters over all flushes of a stream."""
    configure(spark)
    events = inputs.audit(spark, folder).withColumn("action", F.when(F.col("event_id") % 101 != 0, F.col("action")))
    path = work_folder(spark, "ingest")
    run(jobs.ingest_stream(streamed(events, "event_id", "events"), path, KEYRING))
    letters = spark.read.parquet(f"{path}/letters").agg(F.count(F.lit(1)).alias("n"))
    counts = spark.read.parquet(f"{path}/counts").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    return counts.select("accepted", "rejected", letters.select("n").scalar().alias("letters"))


FLUSH, HOURS = 40, 12


@query(
    with_(
        AUDIT,
        "arrived AS (SELECT event_id, tenant, created_ms AS ms, row_number() OVER (PARTITION BY tenant ORDER BY event_id) AS n FROM audit)",
        f"""held AS (
          SELECT tenant, n, event_id, ms AS since, 1 AS held, 0 AS flush FROM arrived WHERE n = 1
          UNION ALL
          SELECT tenant, n, event_id, CASE WHEN held = {FLUSH} THEN ms ELSE since END, held, flush FROM (
            SELECT tenant, n, event_id, ms, flush + CASE WHEN fired AND held > 0 THEN 1 ELSE 0 END AS flush, CASE WHEN fired THEN 1 ELSE held + 1 END AS held,
              CASE WHEN fired THEN since + (ms - since) // {HOURS * 3_600_000} * {HOURS * 3_600_000} ELSE since END AS since
            FROM (
              SELECT r.tenant, r.n, r.event_id, r.ms, h.since, CASE WHEN h.held = {FLUSH} THEN 0 ELSE h.held END AS held,
                h.flush + CASE WHEN h.held = {FLUSH} THEN 1 ELSE 0 END AS flush, r.ms >= h.since + {HOURS * 3_600_000} AS fired
              FROM held h JOIN arrived r ON r.tenant = h.tenant AND r.n = h.n + 1)))""",
        recursive=True,
    )
    + f"""SELECT tenant, flush::BIGINT AS flush, count(*) AS rows, min(event_id) AS first_event, max(event_id) AS last_event, max(held) = {FLUSH} AS counted
      FROM held GROUP BY tenant, flush"""
)
def stream_flush(spark: SparkSession, folder: str) -> DataFrame:
    """Flushes of a buffer per tenant, at forty rows or twelve hours after the last one, across micro-batches."""
    configure(spark)
    events = inputs.audit(spark, folder).select("event_id", "tenant", "created_at")
    path = work_folder(spark, "buffers")
    closed = buffer.flushes(streamed(events, "event_id", "events"), ["tenant"], "event_id", "created_at", FLUSH, HOURS * 3_600_000)
    with state_partitions(spark):
        run(closed.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/_progress").trigger(availableNow=True).start())
        left = buffer.left_rows(spark, f"{path}/_progress", ["tenant"], events.schema)
    rows = spark.read.schema(closed.schema).parquet(f"{path}/rows").unionByName(left)
    return rows.groupBy("tenant", "flush").agg(
        F.count("*").alias("rows"), F.min("row.event_id").alias("first_event"), F.max("row.event_id").alias("last_event"), F.bool_and(F.col("reason") == "count").alias("counted")
    )


@query(
    with_(
        """ordered AS (SELECT event_id, user_id, CASE WHEN event_id % 6 = 0 THEN event_id % 40 ELSE 0 END AS inc,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)"""
    )
    + """SELECT event_id, n + max(inc - n + 1) OVER (PARTITION BY user_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS logical_clock FROM ordered"""
)
def stream_clock(spark: SparkSession, folder: str) -> DataFrame:
    """Clocks per user over a stream, carried from flush to flush."""
    configure(spark)
    events = inputs.audit(spark, folder).select("event_id", F.col("run_id").alias("request_id"), "logical_clock")
    path = work_folder(spark, "clock")
    run(jobs.clock_stream(streamed(events, "event_id", "events"), path))
    return spark.read.parquet(f"{path}/clocked").select("event_id", "logical_clock")


@query("SELECT event_id, event_type FROM events")
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is delivered twice and kept once."""
    configure(spark)
    events = inputs.table(spark, folder, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("created_at"))
    twice = events.unionByName(events.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 SECOND")))
    kept = jobs.drop_repeats(streamed(twice, "event_id", "events"))
    return run_to_table(kept.select("event_id", "event_type"), "dedupe")


@query(
    """SELECT 'c_' || conv_id || '_' || turn AS run_id, 'tool_' || (conv_id % 5) AS tool, conv_id % 13 <> 0 AS success,
      CASE WHEN conv_id % 13 = 0 THEN 'Division by zero' ELSE answer END AS result, length(answer) AS latency_ms
      FROM (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS follower
        FROM conversations) WHERE role = 'user' AND follower = 'assistant' AND conv_id % 17 <> 0"""
)
def stream_pairing(spark: SparkSession, folder: str) -> DataFrame:
    """Tool starts joined to their ends within an hour; runs that never end are dropped."""
    configure(spark)
    c, t = F.col("conv_id"), F.col("turn")
    turns = inputs.table(spark, folder, "conversations")
    base = c * 3_600_000 + t * 60_000
    starts = turns.where("role = 'user'").select(
        inputs.text("c_", c, "_", t).alias("run_id"),
        inputs.text("tool_", c % 5).alias("tool"),
        F.col("text").alias("input"),
        F.timestamp_millis(base).alias("started_at"),
        "conv_id",
    )
    ended = c * 3_600_000 + (t - 1) * 60_000 + F.length("text")
    ends = turns.where("role = 'assistant'").where(c % 17 != 0).select(
        inputs.text("c_", c, "_", t - 1).alias("run_id"),
        F.when(c % 13 == 0, "error").otherwise("end").alias("phase"),
        F.when(c % 13 != 0, F.col("text")).alias("output"),
        F.when(c % 13 == 0, "Division by zero").alias("error"),
        F.timestamp_millis(ended).alias("ended_at"),
        "conv_id",
    )
    joined = jobs.pair_stream(streamed(starts, "conv_id", "starts").drop("conv_id"), streamed(ends, "conv_id", "ends").drop("conv_id"))
    return run_to_table(joined.select("run_id", "tool", "success", "result", "latency_ms"), "pairs")


LATE = 7


@query(
    with_(
        AUDIT,
        f"""numbered AS (
          SELECT *, event_id % {LATE} = 0 AS late, row_number() OVER (PARTITION BY run_id ORDER BY event_id % {LATE} = 0, event_id) AS seq FROM audit)""",
        """texts AS (
          SELECT run_id, user_id, late, string_agg('{"seq":' || seq || ',"toolName":"' || action || '","argsHash":"' || sha256(action || metadata)
            || '","args":' || metadata || ',"output":"' || target || '","latencyMs":' || (event_id % 90) || ',"capturedAt":' || created_ms || '}', ',' ORDER BY seq) AS tools
          FROM numbered GROUP BY ALL)""",
        """heads AS (SELECT DISTINCT run_id, user_id FROM audit),
        parts AS (
          SELECT h.run_id, h.user_id, p.part, coalesce(tools, '') AS tools FROM heads h CROSS JOIN (VALUES (0), (1)) p(part)
          LEFT JOIN texts t ON t.run_id = h.run_id AND t.late = (p.part = 1) WHERE p.part = 0 OR tools IS NOT NULL),
        bundles AS (
          SELECT run_id, part, '{"version":1,"runId":"' || run_id || '","projectId":"p_' || (user_id % 5) || '"'
            || CASE WHEN user_id % 3 <> 0 THEN ',"systemPromptHash":"' || sha256('prompt of ' || user_id) || '","systemPrompt":"prompt of ' || user_id || '"' ELSE '' END
            || ',"tools":[' || tools || '],"committedAt":' || (1706000000000 + user_id) || '}' AS bundle FROM parts)""",
    )
    + """SELECT run_id, part::BIGINT AS part, bundle, sha256(bundle) AS payload_hash,
      CASE WHEN part = 1 THEN lag(sha256(bundle)) OVER (PARTITION BY run_id ORDER BY part) END AS previous_hash FROM bundles"""
)
def stream_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Tool records collected over a stream until their run commits; every seventh comes after that, in a linked further part."""
    configure(spark)
    records = evidence.event_records(spark, folder).drop("seq").withColumnRenamed("event_id", "call_id")
    late = F.col("call_id") % LATE == 0
    rows = records.withColumns({"kind": F.lit("record"), "moment": F.when(late, 2).otherwise(F.col("call_id") % 2)})
    heads = evidence.run_heads(spark, folder).withColumns({"kind": F.lit("commit"), "moment": F.lit(1)})
    stream = streamed(rows.unionByName(heads, allowMissingColumns=True), "moment", "records")
    path = work_folder(spark, "runs")
    run(jobs.bundle_stream(stream, path, lambda: [int_chunk("call_id")]))
    return jobs.stored_bundles(spark, path)


@query(
    with_(AUDIT)
    + """SELECT strftime(created_at, '%Y-%m-%d') AS dt, 'refused' AS error, '{"event_id":' || event_id || ',"target":"' || target || '"}' AS payload FROM audit"""
)
def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Dead letters of a stream, by UTC day."""
    configure(spark)
    events = inputs.audit(spark, folder).select("event_id", "target", "created_at")
    payload = F.to_json(F.struct("event_id", "target"))
    letters = ingest.dead_letters(streamed(events, "event_id", "events"), payload, F.lit("refused"), F.col("created_at"))
    path = work_folder(spark, "letters")
    run(jobs.dead_letter_stream(letters, path))
    back = spark.read.schema("dt date, timestamp string, error string, payload string").json(f"{path}/letters")
    return back.select(F.date_format("dt", "yyyy-MM-dd").alias("dt"), "error", "payload")
