"""Flushes of a stream against a plain replay of its rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from vaultrail.operators import ingest, search
from vaultrail.plans.streams import state_partitions
from vaultrail.streaming import buffer

START = datetime.datetime(2024, 3, 1)
SCHEMA = "event_id bigint, created_at timestamp, sender string, action string, actor string, metadata string, stop boolean"


def events(n=160, seed=0):
    rng = random.Random(seed)
    at, rows = 0, []
    for i in range(n):
        at += rng.choice([0, 1, 30, 200, 900, 2600])
        stop = rng.random() < 0.05
        rows.append((i, START + datetime.timedelta(milliseconds=at), rng.choice(["a", "a", "b", None]), None if i % 11 == 3 else "act", f"u{i % 3}", '{"k": 1}', stop))
    return rows


def feed(spark, rows, path, cuts):
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        spark.createDataFrame(rows[a:b], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def replay(rows, size, interval):
    """(sender, flush, reason, moment) of every event, with a timer that fires on time."""
    buffers, out = {}, {}
    for i, at, sender, *_, stop in rows:
        at = round((at - START).total_seconds() * 1000)
        b = buffers.setdefault(sender, {"since": at, "flush": 0, "held": []})

        def close(reason, moment):
            if b["held"]:
                out.update({e: (sender, b["flush"], reason, moment) for e in b["held"]})
                b.update(flush=b["flush"] + 1, held=[])

        while interval and at >= b["since"] + interval:
            b["since"] += interval
            close("interval", b["since"])
        if stop:
            close("call", at)
            b["since"] = at
            continue
        b["held"].append(i)
        if len(b["held"]) == min(size, 100):
            close("count", at)
            b["since"] = at
    left = {e: (sender, b["flush"], "end", None) for sender, b in buffers.items() for e in b["held"]}
    return out, left, {s: b["since"] for s, b in buffers.items()}


@pytest.mark.parametrize("cuts, size, interval", [([], 7, 2000), ([13, 14, 60, 111], 7, 2000), ([50], 500, None), ([20, 90], 3, 500)])
def test_flushes_are_those_of_a_replay(spark, tmp_path, cuts, size, interval):
    rows = events()
    stream = feed(spark, rows, f"{tmp_path}/in", cuts)
    closed = buffer.flushes(stream, ["sender"], "event_id", "created_at", size, interval, F.col("stop"))
    with state_partitions(spark):
        query = closed.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
        query.awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/out").select("sender", "flush", "reason", F.unix_millis("flushed_at").alias("at"), "row.*").collect()
    zero = round(START.replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)
    got = {r.event_id: (r.sender, r.flush, r.reason, r.at - zero) for r in found}
    left = {r.row.event_id: (r.sender, r.flush) for r in buffer.left_rows(spark, f"{tmp_path}/progress", ["sender"], closed.schema["row"].dataType).collect()}
    done, rest, since = replay(rows, size, interval)
    # The last watermark may have let timers fire that the replay leaves for the end.
    last = round((rows[-1][1] - START).total_seconds() * 1000)
    for e, (sender, flush, _, _) in rest.items():
        if interval and since[sender] + interval < last:
            done[e] = (sender, flush, "interval", since[sender] + interval)
    assert got == done
    assert left == {e: r[:2] for e, r in rest.items() if e not in done}
    assert sorted(got.keys() | left.keys()) == [r[0] for r in rows if not r[-1]]
    by = {r[0]: r for r in rows}
    assert all((r.actor, r.metadata, r.created_at) == (by[r.event_id][4], by[r.event_id][5], by[r.event_id][1]) for r in found)


def test_late_rows_are_kept():
    b = buffer.Buffer(3, 1000)
    for at, payload in [(0, "a"), (500, "b"), (2500, "c"), (100, "late"), (2600, "d"), (2600, None), (2700, "e")]:
        b.push(at, payload)
    assert b.closed == [(0, "interval", 1000, ["a", "b"]), (1, "count", 2600, ["c", "late", "d"])] and b.held == ["e"] and b.flush == 2


def test_lanes_share_a_busy_sender(spark, tmp_path):
    rows = [(i, START, "a", "act", "u", "{}", False) for i in range(200)]
    closed = buffer.flushes(feed(spark, rows, f"{tmp_path}/in", [90]), ["sender"], "event_id", "created_at", 10, lanes=4)
    with state_partitions(spark):
        closed.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start().awaitTermination()
    sizes = spark.read.parquet(f"{tmp_path}/out").groupBy("lane", "flush").count().collect()
    left = buffer.left_rows(spark, f"{tmp_path}/progress", ["sender"], closed.schema["row"].dataType).count()
    assert {r["lane"] for r in sizes} == {0, 1, 2, 3} and all(r["count"] == 10 for r in sizes) and sum(r["count"] for r in sizes) + left == 200


def test_buffered_ingestion_seals_before_it_buffers(spark, ring, tmp_path):
    rows = [r for r in events(90, 3) if not r[-1]]
    stream = feed(spark, rows, f"{tmp_path}/in", [30, 31])
    with state_partitions(spark):
        buffer.buffered_ingest_stream(stream, f"{tmp_path}/out", ring, ["sender"], size=8, interval_ms=3000).awaitTermination()
        for _ in range(2):  # closing twice stores the same once
            buffer.close_buffers(spark, f"{tmp_path}/out", ["sender"])
    stored = spark.read.parquet(f"{tmp_path}/out/rows")
    good = sorted(r[0] for r in rows if r[3])
    opened = search.open_ledger(stored.select(*ingest.ENVELOPE), ring).select("event_id", "opened").collect()
    assert sorted(r.event_id for r in opened) == good and all('"actor":"u' in r.opened for r in opened)
    letters = spark.read.parquet(f"{tmp_path}/out/letters").collect()
    assert len(letters) == len(rows) - len(good) and all(r.error == "action_missing" for r in letters)
    flushed = spark.read.parquet(f"{tmp_path}/out/flushes").collect()
    assert all(r.accepted + r.rejected <= 8 for r in flushed) and sum(r.accepted for r in flushed) == len(good)
    assert {r.reason for r in flushed} >= {"count", "interval"}
    done, rest, _ = replay(rows, 8, 3000)
    assert {(r.sender, r.flush) for r in flushed} == {v[:2] for v in [*done.values(), *rest.values()]}
    # Nothing of an accepted event stands in the state in clear.
    held = spark.read.format("statestore").load(f"{tmp_path}/out/_progress").select(F.explode("value.groupState.payloads").alias("p")).collect()
    assert all('"metadata"' not in r.p for r in held if '"letter"' not in r.p)


def test_a_large_group_is_handed_on_in_pieces():
    """What a call holds and returns at a time does not grow with the rows of its key."""
    import pandas as pd

    class State:
        exists = hasTimedOut = False

        def update(self, value):
            self.value = value

    rows = [(i * 7919 % 50_000, i, None if i % 997 == 0 else f"p{i}") for i in range(50_000)]
    frames = (pd.DataFrame(rows[i : i + 500], columns=["_at", "_order", "_payload"]) for i in range(0, len(rows), 500))
    state = State()
    out = list(buffer._step(["k"], 40, None)(("a",), frames, state))
    assert max(map(len, out)) <= 20 * 40 + 40
    plain = buffer.Buffer(40, None)
    for at, _, payload in sorted(rows, key=lambda r: r[:2]):
        plain.push(at, payload)
    expected = [("a", flush, reason, at, p) for flush, reason, at, held in plain.closed for p in held]
    assert list(pd.concat(out).itertuples(index=False, name=None)) == expected and state.value == (plain.flush, plain.since, plain.held)
