import json

from pyspark.sql import functions as F

from vaultrail.operators import ingest, search
from vaultrail.operators.ordered import int_chunk
from vaultrail.session import materialise
from vaultrail.sources import ledger as store


def events(spark, rows):
    """Events from dicts; columns that no row gives are null."""
    names = sorted({n for r in rows for n in r})
    schema = ", ".join(f"{n} {ingest.AUDIT_EVENT.get(n, 'string')}" for n in names)
    return ingest.with_event_columns(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema))


def sealed(spark, ring, rows, policy=ingest.IngestPolicy()):
    return ingest.seal_events(ingest.guard_events(events(spark, rows), policy), ring, policy)


def opened(spark, ring, rows, policy=ingest.IngestPolicy()):
    found = search.open_ledger(sealed(spark, ring, rows, policy), ring).orderBy("event_id").collect()
    return [(json.loads(r.opened), r) for r in found]


def test_aliases_references_and_redaction(spark, ring):
    policy = ingest.IngestPolicy(redact=("target", "metadata.email"), reference=("actor", "tenant", "metadata.user"))
    rows = [
        {"event_id": 1, "action": "a", "actor_ref": ("usr_1", "john@x.com"), "target": "file", "metadata": '{"email":"e","user":{"id":"u","pii":"p"}}'},
        {"event_id": 2, "action": "a", "actor": "", "actor_id": "usr_2", "tenant_ref": ("t1", "Acme")},
        {"event_id": 3, "action": "a", "actor": "john@x.com"},
        {"event_id": 4, "action": "a"},
    ]
    (p1, r1), (p2, r2), (p3, r3), (p4, r4) = opened(spark, ring, rows, policy)
    assert p1["actor"] == "[REF:usr_1]" and p1["target"] == "[REDACTED:target]"
    assert p1["metadata"] == {"email": "[REDACTED:email]", "user": "[REF:u]"}
    assert r1.actor_index == ring.tokens("john@x.com")[1] == r3.actor_index
    assert r1.target_index == ring.tokens("file")[1]
    assert p2["actor"] == "[REF:usr_2]" and p2["tenant"] == "[REF:t1]" and r2.tenant_index == ring.tokens("Acme")[1]
    assert p3["actor"] == "[REF:john@x.com]"
    assert p4["actor"] == "[REF:unknown]" and "tenant" not in p4 and r4.tenant_index is None
    assert list(p1) == ["actor", "action", "target", "metadata", "context"]


def test_identity_truncation_and_search(spark, ring):
    long = "a" * 300
    rows = [{"event_id": 1, "action": "b" * 300, "actor": long}]
    [(payload, row)] = opened(spark, ring, rows)
    cut = "a" * 255 + "..."
    assert row.actor_index == ring.tokens(cut)[1] and payload["actor"] == long and payload["action"] == "b" * 255 + "..."
    assert search.search_literals(sealed(spark, ring, rows), ring, "actor_index", [long]).count() == 1


def test_payload_text_survives_quotes_and_unicode(spark, ring):
    nasty = 'he said "hi"\n\\ 日本 😀'
    [(payload, row)] = opened(spark, ring, [{"event_id": 1, "action": "a", "actor": nasty, "metadata": json.dumps({"k": nasty}), "span_id": "s", "parent_span_id": "p"}])
    assert payload["actor"] == nasty and payload["metadata"]["k"] == nasty
    assert (payload["spanId"], payload["parentSpanId"]) == ("s", "p")


def test_size_guards(spark):
    many = json.dumps({f"k{i}": "v" * 100 for i in range(200)})
    rows = [
        {"event_id": 1, "action": "a", "metadata": many},
        {"event_id": 2, "action": "a", "metadata": many, "max_meta": 100_000},
        {"event_id": 3, "action": "a", "metadata": "{broken"},
        {"event_id": 4, "metadata": "{}"},
        {"event_id": 5, "action": "a", "metadata": json.dumps({f"k{i}": "x" * 1000 for i in range(5500)}), "max_meta": 100_000_000},
        {"event_id": 6, "action": "a", "metadata": json.dumps({f"k{i}": "x" * 1000 for i in range(250)}), "max_meta": 5_242_880},
        {"event_id": 7, "action": "a"},
    ]
    found = {r.event_id: r.reject_reason for r in ingest.guard_events(events(spark, rows)).collect()}
    assert found == {
        1: "metadata_over_limit", 2: None, 3: "metadata_invalid", 4: "action_missing", 5: "metadata_over_hard_limit", 6: None, 7: None,
    }


def test_size_counts_utf16_units(spark):
    exact = '{"k":"' + "😀" * 50 + '"}'
    rows = [{"event_id": 1, "action": "a", "metadata": exact, "max_meta": 8 + 100}, {"event_id": 2, "action": "a", "metadata": exact, "max_meta": 8 + 99}]
    found = {r.event_id: r.reject_reason for r in ingest.guard_events(events(spark, rows)).collect()}
    assert found == {1: None, 2: "metadata_over_limit"}


def test_claim_check(spark, ring):
    big = json.dumps({f"k{i}": "v" * 1000 for i in range(40)})
    policy = ingest.IngestPolicy(max_metadata=100_000)
    rows = [{"event_id": 1, "action": "a", "metadata": big}, {"event_id": 2, "action": "a", "metadata": "{}"}]
    both = materialise(sealed(spark, ring, rows, policy).withColumn("created_at", F.current_timestamp()), "t")
    main, blobs = ingest.accepted_rows(both), ingest.claim_blobs(both)
    kept = {r.event_id: r for r in main.collect()}
    assert kept[1].is_claim_check and len(kept[1].payload) == 64 and not kept[2].is_claim_check
    assert [b.hash for b in blobs.collect()] == [kept[1].payload] and len(blobs.first().blob) > 30720
    back = search.open_ledger(search.resolve_claims(main, blobs), ring)
    assert json.loads(back.where("event_id = 1").first().opened)["metadata"] == json.loads(big)


def test_agent_context_is_cut(spark, ring):
    rows = [{"event_id": 1, "action": "a", "rationale": "r" * 1500, "tool_name": "t"}, {"event_id": 2, "action": "a"}]
    (_, first), (_, second) = opened(spark, ring, rows)
    assert json.loads(first.agent) == {"rationale": "r" * 1000, "toolName": "t"} and second.agent_context is None


def test_batch_cap_and_counts(spark):
    rows = [{"event_id": i, "action": None if i == 5 else "a", "batch_id": "big"} for i in range(101)]
    rows += [{"event_id": 200 + i, "action": "a", "batch_id": "small"} for i in range(2)]
    capped = ingest.cap_batches(ingest.guard_events(events(spark, rows)), chunk=[int_chunk("event_id", 30)])
    found = {r.batch_id: (r.accepted, r.rejected) for r in ingest.batch_counts(capped).collect()}
    assert found == {"big": (99, 2), "small": (2, 0)}
    flushed = ingest.flush_groups(capped, size=1000).groupBy("batch_id", "flush").count().collect()
    assert {(r.batch_id, r.flush, r["count"]) for r in flushed} == {("big", 0, 100), ("big", 1, 1), ("small", 0, 2)}


def test_rejected_rows_do_not_tick(spark):
    rows = [{"event_id": i, "action": None if i == 1 else "a", "request_id": "r", "logical_clock": 10 if i == 2 else None} for i in range(4)]
    guarded = ingest.guard_events(events(spark, rows))
    found = {r.event_id: r.logical_clock for r in ingest.assign_clocks(guarded, [int_chunk("event_id", 2)]).collect()}
    assert found == {0: 1, 1: None, 2: 11, 3: 12}


def test_ingest_into_stored_ledger(spark, ring, tmp_path):
    rows = [{"event_id": i, "action": "a" if i % 10 else None, "actor": f"u{i % 3}", "request_id": "r"} for i in range(50)]
    frame = events(spark, rows).withColumn("created_at", F.lit("2024-05-01 10:00:00").cast("timestamp"))
    letters = lambda rejected: store.write_dead_letters(
        ingest.dead_letters(rejected, F.to_json(F.struct("event_id")), F.col("reject_reason"), F.col("created_at")), f"{tmp_path}/letters"
    )
    counts = store.ingest_events(frame, f"{tmp_path}/ledger", ring, [int_chunk("event_id")], letters=letters).first()
    assert (counts.accepted, counts.rejected) == (45, 5)
    ledger = store.read_rows(spark, f"{tmp_path}/ledger")
    assert sorted(r.logical_clock for r in ledger.collect()) == list(range(1, 46))
    assert search.search_literals(ledger, ring, "actor_index", ["u1"]).count() == sum(1 for i in range(50) if i % 10 and i % 3 == 1)
    plan = search.search_literals(ledger, ring, "actor_index", ["u1"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(actor_index" in plan
    back = store.read_dead_letters(spark, f"{tmp_path}/letters").collect()
    assert len(back) == 5 and all(str(r.dt) == "2024-05-01" and r.timestamp == "2024-05-01T10:00:00.000Z" for r in back)


def test_typed_guard_needs_no_python(spark):
    frame = events(spark, [{"event_id": 1, "action": "a"}]).withColumn("metadata", F.struct(F.lit("x").alias("k")))
    guarded = ingest.guard_events(frame, metadata_type=frame.schema["metadata"].dataType)
    assert guarded.first().metadata == '{"k":"x"}'
    assert "ArrowEvalPython" not in guarded._jdf.queryExecution().executedPlan().toString()
