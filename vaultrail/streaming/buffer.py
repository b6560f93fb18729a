"""Buffers that are flushed at a number of rows, after an interval, on call or at the end, across micro-batches.

A buffer is keyed state: the rows it holds (fewer than its size), the number of its next flush and the moment of its last one. A
row that fills it closes a flush. A timer that was started at the last flush closes one when the interval is over, and starts
again; it goes by the rows' own time, so a buffer whose timer fires late (with its next row, or when the watermark passes)
has the same flushes as one whose timer fires at once, and a repeated micro-batch has the same again. What is left when the stream ends
is read from the state store and is the last flush.

A buffer stands for one sender and its rows are worked on in order by one task; one that is too busy is spread over ``lanes``, as
if several senders shared its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from vaultrail.functions.crypto import Keyring
from vaultrail.operators import ingest
from vaultrail.session import remove_folder, work_folder
from vaultrail.streaming import jobs

#: Fixed value: rows of a flush at most.
MOST = 100

#: Rows that are taken out of a micro-batch at a time, and flushes that are handed on at a time.
ROWS, PIECE = 2000, 20

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_STATE = "flush long, since long, payloads array<string>"


class Buffer:
    """One buffer, row by row; times are milliseconds."""

    def __init__(self, size: int, interval: int | None, flush: int = 0, since: int | None = None, held: list[str] | None = None):
        self.size, self.interval = min(size, MOST), interval
        self.flush, self.since, self.held = flush, since, list(held or [])
        self.closed: list[tuple[int, str, int, list[str]]] = []

    def close(self, reason: str, at: int) -> None:
        if self.held:
            self.closed.append((self.flush, reason, at, self.held))
            self.flush, self.held = self.flush + 1, []

    def pass_time(self, now: int) -> None:
        """Let the timer fire as often as it would have by ``now``; only the first time can find rows."""
        if self.interval and self.since is not None and now >= self.since + self.interval:
            self.close("interval", self.since + self.interval)
            self.since += (now - self.since) // self.interval * self.interval

    def push(self, at: int, payload: str | None) -> None:
        """A row, or a call to flush if there is no payload. A row that is older than the last flush counts as of then."""
        at = at if self.since is None else max(at, self.since)
        self.since = at if self.since is None else self.since
        self.pass_time(at)
        if payload is not None:
            self.held.append(payload)
        if payload is None or len(self.held) >= self.size:
            self.close("call" if payload is None else "count", at)
            self.since = at


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, str | None]]:
    """Moments and payloads of a buffer's rows in a micro-batch, by moment and order; payloads are held as bytes, not as objects."""
    at, number, texts = [], [], []
    for f in frames:
        at.append(f["_at"].to_numpy(np.int64))
        number.append(f["_order"].to_numpy())
        texts.append(pa.array(f["_payload"], pa.large_string(), from_pandas=True))
    moments, payloads = np.concatenate(at), pa.concat_arrays(texts)
    order = np.lexsort((np.concatenate(number), moments))
    del at, number, texts
    for i in range(0, len(order), ROWS):
        part = order[i : i + ROWS]
        yield from zip(moments[part].tolist(), payloads.take(pa.array(part)).to_pylist(), strict=True)


def _step(keys: list[str], size: int, interval: int | None) -> Callable:
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        def written(buffer: Buffer) -> pd.DataFrame:
            closed, buffer.closed = buffer.closed, []
            out = [(*key, flush, reason, at, payload) for flush, reason, at, held in closed for payload in held]
            return pd.DataFrame(out, columns=[*keys, "flush", "reason", "flushed_ms", "_payload"])

        buffer = Buffer(size, interval, *(state.get if state.exists else ()))
        if state.hasTimedOut:
            buffer.pass_time(state.getCurrentWatermarkMs())
        else:
            for at, payload in _in_order(frames):
                buffer.push(at, payload)
                if len(buffer.closed) >= PIECE:
                    yield written(buffer)
            # A timer that the watermark has passed already fires here; it must not be set any more.
            if interval and buffer.held and buffer.since + interval <= state.getCurrentWatermarkMs():
                buffer.pass_time(state.getCurrentWatermarkMs())
        state.update((buffer.flush, buffer.since, buffer.held))
        if interval and buffer.held:
            state.setTimeoutTimestamp(buffer.since + interval)
        yield written(buffer)

    return run


def _opened(rows: DataFrame, keys: list[str], schema: StructType) -> DataFrame:
    held = F.from_json("_payload", schema, _JSON)
    return rows.select(*keys, "flush", "reason", F.timestamp_millis("flushed_ms").alias("flushed_at"), held.alias("row"))


def flushes(stream: DataFrame, keys: list[str], order: str, at: str, size: int = MOST, interval_ms: int | None = None, call: Column | None = None, delay: str = "0 seconds", lanes: int = 1) -> DataFrame:
    """Rows of a stream as they leave their buffer: keys, lane, flush (from 0), reason, flushed_at, and the whole ``row``.

    Flushes close at ``size`` rows (at most 100), when ``interval_ms`` has passed since the last flush (since the first row, to begin
    with), or at a row for which ``call`` holds, which is no data itself. ``at`` is the rows' timestamp, which must not be null, and
    ``order`` a whole number that orders rows of the same moment. Rows with null keys share a buffer. Rows that come later than
    ``delay`` are not dropped; they count as of the last flush.
    """
    lane = F.pmod(F.xxhash64(order), F.lit(lanes)).cast("int") if lanes > 1 else F.lit(0)
    payload = F.to_json(F.struct(*stream.columns), _JSON)
    called = F.lit(False) if call is None else F.coalesce(call, F.lit(False))
    # Timers go by the watermark of ``at``. What the operator sees as event time is later than any watermark, so that Spark
    # drops no row as late.
    never_late = F.lit("2262-01-01").cast("timestamp").alias("_mark", metadata={"spark.watermarkDelayMs": 0})
    rows = stream.withWatermark(at, delay).select(*keys, lane.alias("lane"), never_late, F.unix_millis(at).alias("_at"), F.col(order).cast("long").alias("_order"), F.when(~called, payload).alias("_payload"))
    names = [*keys, "lane"]
    types = dict(rows.dtypes)
    schema = ", ".join(f"`{n}` {types[n]}" for n in names) + ", flush long, reason string, flushed_ms long, _payload string"
    out = rows.groupBy(*names).applyInPandasWithState(_step(names, size, interval_ms), schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return _opened(out, names, stream.schema)


def left_rows(spark: SparkSession, checkpoint: str, keys: list[str], schema: StructType) -> DataFrame:
    """Rows that a stopped query has left in its buffers, as their last flush (reason ``end``, of no moment)."""
    held = spark.read.format("statestore").load(checkpoint).select("key.*", "value.groupState.*")
    rows = held.select(*keys, "lane", "flush", F.lit("end").alias("reason"), F.lit(None).cast("long").alias("flushed_ms"), F.explode("payloads").alias("_payload"))
    return _opened(rows, [*keys, "lane"], schema)


# --- ingestion -------------------------------------------------------------------------------------------------------


def _sealed(events: DataFrame, keyring: Keyring, policy: ingest.IngestPolicy, extra: list[str | Column]) -> DataFrame:
    """What of an event may be held and stored; of a rejected one its dead letter."""
    guarded = ingest.guard_events(ingest.with_event_columns(events), policy)
    letter = F.when(F.col("reject_reason").isNotNull(), jobs.letter_text()).alias("letter")
    return ingest.seal_events(guarded, keyring, policy).select(*ingest.ENVELOPE, "reject_reason", letter, jobs.clock_scope().alias("request_id"), *extra)


def _stored(flushed: DataFrame, path: str, batch: int, names: list[str]) -> None:
    """Store the rows of closed flushes as one micro-batch, and what each flush had accepted and rejected."""
    spark = flushed.sparkSession
    folder = work_folder(spark, "flush")
    fields = [*ingest.ENVELOPE, "reject_reason", "letter", "request_id"]
    flushed.select(F.struct(*names, "flush", "reason", "flushed_at").alias("_flush"), *(f"row.{n}" for n in fields)).write.parquet(folder)
    staged = ingest.staged_rows(spark, folder)
    jobs.store_sealed(staged, path, batch)
    bad = F.col("reject_reason").isNotNull()
    letters = ingest.dead_letters(staged.where(bad), F.col("letter"), F.col("reject_reason"), F.col("created_at"))
    jobs.replace_batch(letters, path, "letters", batch, ["dt"])
    counts = staged.groupBy("_flush").agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    jobs.replace_batch(counts.select("_flush.*", "accepted", "rejected"), path, "flushes", batch)
    remove_folder(spark, folder)


def buffered_ingest_stream(stream: DataFrame, path: str, keyring: Keyring, keys: list[str], size: int = MOST, interval_ms: int | None = None, call: Column | None = None, policy: ingest.IngestPolicy = ingest.IngestPolicy(), trigger: dict | None = None, lanes: int = 1) -> StreamingQuery:
    """Audit events into the ledger as their buffers are flushed; the tables below ``path`` are those of ``ingest_stream``, and ``flushes``.

    Events are sealed before they are buffered, so the state holds no plaintext but that of rejected events, as their dead
    letters do. ``keys`` are columns of the stream. :func:`close_buffers` stores what is left when the query has ended.
    """
    called = F.lit(False) if call is None else F.coalesce(call, F.lit(False))
    sealed = _sealed(stream.withColumn("_call", called), keyring, policy, [*(F.col(k).alias(f"_key_{k}") for k in keys), "_call"])
    names = [f"_key_{k}" for k in keys]
    closed = flushes(sealed, names, "event_id", "created_at", size, interval_ms, F.col("_call"), lanes=lanes)
    return jobs.run_batches(closed, lambda rows, batch: _stored(_named(rows, keys), path, batch, [*keys, "lane"]), f"{path}/_progress", trigger)


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumnsRenamed({f"_key_{k}": k for k in keys})


def close_buffers(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Store what the ended query at ``path`` has left in its buffers, as one more micro-batch; it can't be started again after that.

    Doing it twice replaces the same batch with the same rows.
    """
    empty = _sealed(spark.createDataFrame([], "event_id bigint"), Keyring({"v1": "-"}, "v1"), ingest.IngestPolicy(), [])
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_progress/commits")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    last = max(int(f.getPath().getName()) for f in files if f.getPath().getName().isdigit())
    held = left_rows(spark, f"{path}/_progress", [f"_key_{k}" for k in keys], empty.schema)
    _stored(_named(held, keys), path, last + 1, [*keys, "lane"])
