"""Batches, snapshots and blobs of a stored ledger."""

import os

import pytest
from pyspark.sql import functions as F

from vaultrail.operators import ingest, search
from vaultrail.operators.ordered import int_chunk
from vaultrail.sources import ledger as store

LARGE = "x" * 40_000


def events(spark, rows):
    frame = spark.createDataFrame(rows, "event_id bigint, actor string, metadata string, created_at string")
    return frame.withColumns({"action": F.lit("put"), "created_at": F.col("created_at").cast("timestamp")})


def sealed(spark, ring, rows):
    frame = ingest.with_event_columns(events(spark, rows))
    return ingest.seal_events(frame.withColumn("reject_reason", F.lit(None).cast("string")), ring)


def ids(frame):
    return sorted(r.event_id for r in frame.collect())


def parquet_files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_a_batch_counts_once(spark, ring, tmp_path):
    """The same batch again, complete or half written, gives each row and blob once."""
    path = f"{tmp_path}/ledger"
    rows = [(1, "ann", '{"a":"' + LARGE + '"}', "2024-01-01"), (2, "bob", "{}", "2024-01-02")]

    def died(rejected):
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        store.append(sealed(spark, ring, rows), path, letters=died, batch="b-1")
    assert os.path.exists(f"{path}/rows/batch=b-1") and store.read_rows(spark, path).count() == 0 and store.read_blobs(spark, path).count() == 0
    for _ in range(2):
        assert store.append(sealed(spark, ring, rows), path, batch="b-1").collect() == [(2, 0)]
        assert ids(store.read_rows(spark, path)) == [1, 2] and store.read_blobs(spark, path).count() == 1
    assert store.append(sealed(spark, ring, []), path, batch="none").collect() == [(0, 0)]
    store.append(sealed(spark, ring, [(3, "ann", "{}", None)]), path)
    assert ids(store.read_rows(spark, path)) == [1, 2, 3]
    with pytest.raises(ValueError):
        store.append(sealed(spark, ring, rows), path, batch="a/b")


def test_ingestion_of_a_batch_again(spark, ring, tmp_path):
    path = f"{tmp_path}/ledger"
    for _ in range(2):
        found = store.ingest_events(events(spark, [(1, "ann", "{}", "2024-01-01"), (2, None, "{}", "2024-01-01")]), path, ring, [int_chunk("event_id")], batch="b")
        assert sum(found.first()) == 2
    assert store.read_rows(spark, path).count() == found.first().accepted


def test_purge_rewrites_only_files_with_erased_rows(spark, ring, tmp_path):
    """Files of other days and batches are referred to, in the snapshot of a snapshot too; replaced ones can be deleted."""
    old, new, last = (f"{tmp_path}/{n} ledger" for n in ("old", "new", "last"))
    text = lambda who: '{"a":"' + who + LARGE + '"}'
    store.append(sealed(spark, ring, [(1, "ann", text("ann"), "2024-01-01"), (2, "bob", "{}", "2024-01-01"), (3, "bob", text("bob"), "2024-01-02")]), old, batch="a")
    store.append(sealed(spark, ring, [(4, "bob", text("bob"), "2024-01-03"), (5, "eve", "{}", "2024-01-03")]), old, batch="b")
    before = parquet_files(f"{old}/rows")
    wanted = lambda *names: spark.createDataFrame([(n, None) for n in names], "actor string, max_created_at timestamp")
    assert [r.deleted_count for r in store.purge(spark, old, new, wanted("ann"), ring).collect()] == [1]
    assert parquet_files(f"{old}/rows") == before
    written = parquet_files(f"{new}/rows")
    assert written and all("day=2024-01-01" in f for f in written)
    assert ids(store.read_rows(spark, new)) == [2, 3, 4, 5]
    days = {r.event_id: str(r.day) for r in store.read_rows(spark, new).collect()}
    assert days == {2: "2024-01-01", 3: "2024-01-02", 4: "2024-01-03", 5: "2024-01-03"}
    assert store.erase_replaced(spark, new) >= 1
    gone = set(before) - set(parquet_files(f"{old}/rows"))
    assert gone and all("day=2024-01-01" in f for f in gone)

    def opened(path):
        rows = search.resolve_claims(store.read_rows(spark, path), store.read_blobs(spark, path))
        return {r.event_id: r.opened for r in search.open_ledger(rows, ring).collect()}

    assert sorted(opened(new)) == [2, 3, 4, 5] and "bob" + LARGE in opened(new)[3]
    store.purge(spark, new, last, wanted("eve", "nobody"), ring)
    assert ids(store.read_rows(spark, last)) == [2, 3, 4] and opened(last)[4] == opened(new)[4]
    assert all("day=2024-01-03" in f for f in parquet_files(f"{last}/rows"))
    none = f"{tmp_path}/none"
    assert store.purge(spark, last, none, wanted("nobody"), ring).count() == 0
    assert ids(store.read_rows(spark, none)) == [2, 3, 4] and not any(os.path.getsize(f) > 8000 for f in parquet_files(f"{none}/blobs"))
    with pytest.raises(ValueError):
        store.erase_replaced(spark, old)


def test_blobs_that_fail_stay_inline(spark, ring, tmp_path):
    """Some blobs are refused, some raise; their rows open as if they had been small."""
    path, folder = f"{tmp_path}/ledger", f"{tmp_path}/objects"
    os.mkdir(folder)

    def put(name, text):
        if len(text) > 90_000:
            raise OSError("too large")
        if len(text) > 70_000:
            return False
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)

    rows = [(i, "ann", '{"a":"' + "x" * n + '"}', "2024-01-01") for i, n in enumerate((10, 40_000, 55_000, 80_000))]
    assert store.append(sealed(spark, ring, rows), path, put=put).collect() == [(4, 0)]
    found = store.read_rows(spark, path)
    assert {r.event_id: r.is_claim_check for r in found.collect()} == {0: False, 1: True, 2: False, 3: False}
    assert len(os.listdir(folder)) == 1
    blobs = spark.createDataFrame([(n, open(f"{folder}/{n}").read()) for n in os.listdir(folder)], store.BLOBS)
    opened = search.open_ledger(search.resolve_claims(found, blobs), ring).collect()
    assert len(opened) == 4 and all(r.opened.count("x") >= n for r, n in zip(sorted(opened, key=lambda r: r.event_id), (10, 40_000, 55_000, 80_000), strict=True))


def test_clocks_move_no_sealed_columns(spark, ring, tmp_path):
    """Windows of the clocks see narrow rows only; rows that share an id keep a clock each, and the stage is stored compactly."""
    frame = spark.createDataFrame([(i // 2, "put", f"r{i % 3}", "x" * 100) for i in range(40)], "event_id bigint, action string, request_id string, target string")
    sealed = ingest.seal_events(ingest.guard_events(ingest.with_event_columns(frame)), ring)
    sealed.select(*ingest.ENVELOPE, "reject_reason", "request_id").write.parquet(f"{tmp_path}/stage")
    seen = []

    def clocks(rows):
        seen.extend(rows.columns)
        return ingest.assign_clocks(rows, [int_chunk("event_id")])

    rows = ingest.with_clocks(ingest.staged_rows(spark, f"{tmp_path}/stage"), clocks)
    assert not {"payload", "agent_context", "actor_index", "trace_index"} & set(seen)
    found = rows.select("request_id", "logical_clock", "payload").collect()
    assert len(found) == 40 and all(r.payload for r in found)
    assert sorted((r.request_id, r.logical_clock) for r in found) == sorted((f"r{k}", i + 1) for k in range(3) for i in range(14 if k == 0 else 13))
    assert all(".zstd." in f for f in spark.read.parquet(f"{tmp_path}/stage").inputFiles())


def test_purge_matches_requests_without_payloads(spark, ring, tmp_path, monkeypatch):
    """What a purge covers is found from ids, indexes, times and pointers; inline payloads meet only the rows of files written anew."""
    from vaultrail.operators import access

    frame = spark.createDataFrame([(1, "ann", "put"), (2, "bob", "put")], "event_id bigint, actor string, action string")
    store.ingest_events(frame.withColumn("metadata", F.lit("{}")), f"{tmp_path}/a", ring, [int_chunk("event_id")])
    seen, own = [], access.mark_purged
    monkeypatch.setattr(access, "mark_purged", lambda ledger, *rest, **more: (seen.append(ledger.columns), own(ledger, *rest, **more))[1])
    store.purge(spark, f"{tmp_path}/a", f"{tmp_path}/b", spark.createDataFrame([("ann", None)], "actor string, max_created_at timestamp"), ring)
    assert "payload" not in seen[0]
    assert [r.event_id for r in store.read_rows(spark, f"{tmp_path}/b").collect()] == [2]
