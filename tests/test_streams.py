import json
import random

import pytest
from pyspark.sql import functions as F

from vaultrail.operators import agents, ingest, search
from vaultrail.operators.ordered import int_chunk
from vaultrail.streaming import jobs


def feed(spark, frames, path):
    """A file stream that delivers each frame as one micro-batch."""
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def clock_rows(n=60):
    rng = random.Random(4)
    return [(i, rng.choice(["hot", "hot", "b"]), rng.choice([None, rng.randrange(80)])) for i in range(n)]


def clock_frames(spark, rows, size=10):
    schema = "event_id bigint, request_id string, logical_clock bigint"
    return [spark.createDataFrame(rows[i : i + size], schema) for i in range(0, len(rows), size)]


def folded(rows):
    clocks, out = {}, {}
    for i, scope, incoming in rows:
        clocks[scope] = out[i] = max(clocks.get(scope, 0), incoming or 0) + 1
    return out


def test_clock_is_carried_and_restarts_add_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "SNAPSHOT_EVERY", 2)
    rows = clock_rows()
    frames = clock_frames(spark, rows)
    out = f"{tmp_path}/out"
    jobs.clock_stream(feed(spark, frames[:3], f"{tmp_path}/in"), out, [int_chunk("event_id", 3)]).awaitTermination()
    stream = feed(spark, frames[3:], f"{tmp_path}/in")
    jobs.clock_stream(stream, out, [int_chunk("event_id", 3)]).awaitTermination()
    jobs.clock_stream(stream, out, [int_chunk("event_id", 3)]).awaitTermination()
    found = spark.read.parquet(f"{out}/clocked").collect()
    assert len(found) == len(rows) and {r.event_id: r.logical_clock for r in found} == folded(rows)


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    rows = clock_rows(20)
    frames = clock_frames(spark, rows)
    path = str(tmp_path)
    for batch, frame in [(0, frames[0]), (1, frames[1]), (1, frames[1])]:
        clocked = jobs.clock_batch(frame, path, batch)
        jobs.replace_batch(clocked, path, "clocked", batch)
        jobs.replace_batch(clocked.groupBy("request_id").agg(F.max("logical_clock").alias("clock")), path, "clock_deltas", batch)
    found = spark.read.parquet(f"{path}/clocked").collect()
    assert {r.event_id: r.logical_clock for r in found} == folded(rows) and len(found) == len(rows)


def test_ingest_stream_equals_batch(spark, ring, tmp_path):
    big = json.dumps({f"k{i}": "v" * 1000 for i in range(40)})
    rows = [(i, f"r{i % 2}", None if i == 7 else "act", f"u{i % 3}", big if i == 5 else '{"a": 1.0}') for i in range(30)]
    schema = "event_id bigint, request_id string, action string, actor string, metadata string"
    frames = [spark.createDataFrame(rows[i : i + 10], schema).withColumn("created_at", F.lit("2024-03-01 23:59:59").cast("timestamp")) for i in (0, 10, 20)]
    policy = ingest.IngestPolicy(max_metadata=100_000)
    jobs.ingest_stream(feed(spark, frames, f"{tmp_path}/in"), f"{tmp_path}/out", ring, policy).awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/out/rows").select(*ingest.ENVELOPE)
    whole = spark.read.parquet(f"{tmp_path}/in")
    guarded = ingest.guard_events(ingest.with_event_columns(whole), policy)
    batch = ingest.accepted_rows(ingest.seal_events(ingest.assign_clocks(guarded, [int_chunk("event_id")]), ring, policy))
    key = lambda frame: sorted((tuple(r) for r in frame.select("event_id", "actor_index", "payload", "logical_clock", "is_claim_check").collect()))
    assert key(stored) == key(batch)
    opened = search.open_ledger(search.resolve_claims(stored, spark.read.parquet(f"{tmp_path}/out/blobs")), ring)
    assert json.loads(opened.where("event_id = 5").first().opened)["metadata"] == json.loads(big)
    counts = spark.read.parquet(f"{tmp_path}/out/counts").agg(F.sum("accepted"), F.sum("rejected")).first()
    assert tuple(counts) == (29, 1)
    letter = spark.read.parquet(f"{tmp_path}/out/letters").first()
    assert letter.error == "action_missing" and json.loads(letter.payload)["event_id"] == 7 and str(letter.dt) == "2024-03-01"
    sent = json.loads(letter.payload)
    assert (sent["actor"], sent["request_id"], sent["metadata"]) == ("u1", "r1", '{"a":1}')
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"rows", "blobs", "letters", "counts", "clock_deltas", "_progress"}
    assert set(spark.read.parquet(f"{tmp_path}/out/rows").columns) == {*ingest.ENVELOPE, "batch"}


def test_ingest_stream_hands_over_rejected_rows(spark, ring, tmp_path):
    """The caller's sink gets whole events; events outside requests share a clock that goes on from flush to flush."""
    schema = "event_id bigint, request_id string, action string, metadata string"
    frames = [spark.createDataFrame([(i, None, "act", "{}"), (i + 1, "", "act", "{}"), (i + 2, None, None, "{}")], schema) for i in (0, 10)]
    taken = []
    sink = lambda rows, batch: taken.extend((batch, r.event_id, r.reject_reason) for r in rows.collect())
    jobs.ingest_stream(feed(spark, frames, f"{tmp_path}/in"), f"{tmp_path}/out", ring, letters=sink).awaitTermination()
    assert taken == [(0, 2, "action_missing"), (1, 12, "action_missing")]
    rows = spark.read.parquet(f"{tmp_path}/out/rows")
    assert {r.event_id: r.logical_clock for r in rows.collect()} == {0: 1, 1: 1, 10: 2, 11: 2}


def test_bundles_wait_for_their_commit(spark, tmp_path, monkeypatch):
    schema = (
        "kind string, run_id string, call_id bigint, tool string, args_hash string, args string, output string, latency_ms bigint, "
        "captured_at bigint, project_id string, system_prompt string, committed_at bigint"
    )

    def record(run, n):
        return ("record", run, n, "t", "h", "{}", str(n), 1, n, None, None, None)

    def commit(run):
        return ("commit", run, None, None, None, None, None, None, None, "p", "prompt", 9)

    batches = [
        [record("a", 1), record("b", 1)], [record("a", 3), record("a", 2), commit("b")], [commit("a"), record("c", 1)],
        [record("b", 7), record("b", 6), record("a", 9)], [commit("c"), commit("b")], [record("b", 8), commit("d")], [record("e", 1)],
    ]
    frames = [spark.createDataFrame(b, schema) for b in batches]
    out = f"{tmp_path}/out"
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 2)
    jobs.bundle_stream(feed(spark, frames, f"{tmp_path}/in"), out, lambda: [int_chunk("call_id")]).awaitTermination()
    found = {(r.run_id, r.part): r for r in jobs.stored_bundles(spark, out).collect()}
    assert {k: [(t["seq"], t["output"]) for t in json.loads(v.bundle)["tools"]] for k, v in found.items()} == {
        ("a", 0): [(1, 1), (2, 2), (3, 3)], ("a", 1): [(4, 9)], ("b", 0): [(1, 1)], ("b", 1): [(2, 6), (3, 7)], ("b", 2): [(4, 8)], ("c", 0): [(1, 1)], ("d", 0): [],
    }
    for (run, part), r in found.items():
        assert r.previous_hash == (found[run, part - 1].payload_hash if part else None)
    # A micro-batch writes its own records only, and the log is cut down to those of open runs.
    assert [spark.read.parquet(f"{out}/records/batch={b}").count() for b in range(7)] == [2, 2, 1, 3, 0, 1, 1]
    assert sorted(r.run_id for r in spark.read.parquet(f"{out}/records_compacted/batch=6").collect()) == []
    assert sorted(r.run_id for r in spark.read.parquet(f"{out}/records_compacted/batch=4").collect()) == ["c"]


def run_to_table(stream, path):
    writer = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/_progress")
    writer.trigger(availableNow=True).start().awaitTermination()
    return f"{path}/rows"


def test_repeats_across_micro_batches_are_dropped(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i:02}:00") for i in range(20)]
    frame = lambda part: spark.createDataFrame(part, "event_id bigint, t string").select("event_id", F.to_timestamp("t").alias("created_at"))
    stream = feed(spark, [frame(rows[:10]), frame(rows[5:15]), frame(rows[10:] + rows[:3])], f"{tmp_path}/in")
    found = spark.read.parquet(run_to_table(jobs.drop_repeats(stream), f"{tmp_path}/out")).collect()
    assert sorted(r.event_id for r in found) == list(range(20))


def test_pairing_across_micro_batches(spark, tmp_path):
    def starts(rows):
        frame = spark.createDataFrame(rows, "run_id string, tool string, input string, t string")
        return frame.select("run_id", "tool", "input", F.to_timestamp("t").alias("started_at"))

    def ends(rows):
        frame = spark.createDataFrame(rows, "run_id string, phase string, output string, error string, t string")
        return frame.select("run_id", "phase", "output", "error", F.to_timestamp("t").alias("ended_at"))

    left = feed(spark, [starts([("a", "t", "i", "2024-01-01 00:00:00"), ("b", None, "i", "2024-01-01 00:01:00")]), starts([("c", "t", "i", "2024-01-01 00:30:00")])], f"{tmp_path}/s")
    right = feed(spark, [ends([("x", "end", "o", None, "2024-01-01 00:00:10")]), ends([("a", "end", "o", None, "2024-01-01 00:20:00"), ("b", "error", None, "boom", "2024-01-01 00:01:01"), ("c", "end", "late", None, "2024-01-01 02:00:00")])], f"{tmp_path}/e")
    found = spark.read.parquet(run_to_table(jobs.pair_stream(left, right), f"{tmp_path}/out")).collect()
    assert {r.run_id: (r.tool, r.success, r.result, r.latency_ms) for r in found} == {"a": ("t", True, "o", 1_200_000), "b": ("unnamed_tool", False, "boom", 1000)}


def test_dead_letters_by_day(spark, tmp_path):
    frame = spark.range(50).withColumn("at", F.timestamp_seconds(F.col("id") * 7200))
    letters = ingest.dead_letters(feed(spark, [frame], f"{tmp_path}/in"), F.to_json(F.struct("id")), F.lit("Delivery failed"), F.col("at"))
    jobs.dead_letter_stream(letters, f"{tmp_path}/out").awaitTermination()
    back = spark.read.json(f"{tmp_path}/out/letters").collect()
    assert sorted(json.loads(r.payload)["id"] for r in back) == list(range(50))
    assert {str(r.dt) for r in back} == {f"1970-01-0{d}" for d in range(1, 6)}
