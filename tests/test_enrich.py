import json
import random

from pyspark.sql import functions as F

from vaultrail.functions.jsontext import member, object_of, quote, splice
from vaultrail.functions.metadata import guard
from vaultrail.operators import enrich


def test_controls_win_over_own_metadata(spark):
    frame = spark.createDataFrame(
        [("access.granted", '{"soc2_control":"mine","x":1}'), ("mfa.enabled", None), ("other", "{}")], "action string, metadata string"
    )
    rows = {r.action: json.loads(r.m) for r in enrich.tag_compliance(frame).select("action", guard("metadata")["metadata"].alias("m")).collect()}
    assert rows == {
        "access.granted": {"soc2_control": "CC6.1", "x": 1, "iso27001": "A.9.2.1"},
        "mfa.enabled": {"soc2_control": "CC6.3", "iso27001": "A.9.4.2"},
    }


def test_agent_fields_between_metadata_and_controls(spark):
    frame = spark.createDataFrame([("refusal", '{"reason":"a","k":1}', '{"reason":"b","iso27001":"c"}')], "kind string, metadata string, fields string")
    row = enrich.tag_agent_events(frame).select("action", guard("metadata")["metadata"].alias("m")).first()
    assert row.action == "agent.refusal"
    assert json.loads(row.m) == {
        "reason": "b", "k": 1, "iso27001": "A.18.1.3", "eu_ai_act": "Article 5", "nist_ai_rmf": "GOVERN 1.1", "soc2_control": "CC6.8",
    }


def test_json_text(spark):
    frame = spark.createDataFrame([('{"a": 1 }', "{ }", None, 'x"\n')], "a string, b string, c string, q string")
    row = frame.select(splice("a", "b", "c", F.lit('{"d":2}')).alias("s"), object_of(("q", quote("q")), ("n", F.col("c"))).alias("o")).first()
    assert row.s == '{"a": 1,"d":2}' and json.loads(row.o) == {"q": 'x"\n'}
    assert frame.select(member("a", "a").alias("m")).first().m == "1"


def test_sessions_and_runs(spark):
    events = spark.createDataFrame(
        [(1, "u", None, '{"email":"own"}', None, "r", "", None), (2, "v", "kept", "{}", "t", "q", "tool", "why")],
        "event_id int, user_id string, actor string, metadata string, trace_id string, run_id string, tool_name string, rationale string",
    ).withColumn("span_id", F.lit(None).cast("string"))
    sessions = spark.createDataFrame([("u", "usr_u", '{"email":"s","plan":"p"}')], "user_id string, session_actor string, session_metadata string")
    rows = {r.event_id: r for r in enrich.attach_sessions(events, sessions).withColumn("metadata", guard("metadata")["metadata"]).collect()}
    assert rows[1].actor == "usr_u" and json.loads(rows[1].metadata) == {"email": "own", "plan": "p"}
    assert rows[2].actor == "kept" and rows[2].metadata == "{}"
    runs = spark.createDataFrame([("r", "rt", "rs", "rr", "rn"), ("q", "x", "x", "x", "x")],
                                 "run_id string, run_trace_id string, run_span_id string, run_rationale string, run_tool_name string")
    rows = {r.event_id: r for r in enrich.attach_runs(events, runs).collect()}
    assert (rows[1].trace_id, rows[1].span_id, rows[1].rationale, rows[1].tool_name) == ("rt", "rs", "rr", "rn")
    assert (rows[2].trace_id, rows[2].span_id, rows[2].rationale, rows[2].tool_name) == ("t", "x", "why", "tool")


def test_request_context_below_own(spark):
    context = "struct<ip:string,userAgent:string,location:struct<country:string,region:string,city:string>,device:struct<browser:string,os:string,type:string>>"
    events = spark.createDataFrame([(1, "r", ("9.9.9.9", None, (None, "R", None), None)), (2, "none", None)], f"event_id int, request_id string, context {context}")
    requests = spark.createDataFrame(
        [("r", ("1.1.1.1", "UA", ("DE", "X", "B")), (None, None, 7))],
        "request_id string, client struct<ip:string,userAgent:string,location:struct<country:string,region:string,city:string>>, "
        "trace struct<trace_id:string,span_id:string,logical_clock:bigint>",
    )
    rows = {r.event_id: r for r in enrich.attach_requests(events, requests).collect()}
    assert (rows[1].context.ip, rows[1].context.userAgent, tuple(rows[1].context.location), rows[1].clock_base) == ("9.9.9.9", "UA", ("DE", "R", "B"), 7)
    assert rows[2].context.ip is None and rows[2].clock_base == 0


def test_active_span_equals_brute_force(spark):
    rng = random.Random(3)
    spans = [(f"s{rng.randrange(2)}", (b := rng.randrange(-500, 1000)), b + rng.choice([0, 5, 40, 700]), f"t{i}", f"sp{i:03}", f"p{i}") for i in range(120)]
    events = [(i, f"s{rng.randrange(3)}", rng.randrange(-600, 1400), "own" if i % 7 == 0 else "", None, None) for i in range(400)]
    span_frame = spark.createDataFrame(spans, "service string, start bigint, end bigint, trace_id string, span_id string, parent_span_id string")
    event_frame = spark.createDataFrame(events, "event_id int, service string, at bigint, trace_id string, span_id string, parent_span_id string")
    for width in (100, 7, 5000):
        found = {r.event_id: (r.trace_id, r.span_id, r.parent_span_id) for r in enrich.active_spans(event_frame, span_frame, width).collect()}
        for i, service, at, trace, *_ in events:
            open_now = [s for s in spans if s[0] == service and s[1] <= at <= s[2]]
            best = max(open_now, key=lambda s: (s[1], s[4]), default=None)
            expected = (trace or (best[3] if best else None), best[4] if best else None, best[5] if best else None)
            assert found[i] == expected, (width, i)
        assert len(found) == len(events)


def test_large_buckets_are_divided(spark):
    """One service with everything in a few buckets: parts of any width give what brute force gives, and spread over tasks."""
    rng = random.Random(5)
    ends = [0, 1, 3, 60, 400, 9000]
    spans = [("s" if i % 5 else "t", (b := rng.randrange(-3000, 12000)), b + rng.choice(ends), f"t{i}", f"sp{i:03}", f"p{i}") for i in range(200)]
    spans += [("s", -4000, None, "t", "zz", "p"), ("s", 0, 8191, "t", "whole", "p"), ("s", 4096, 8191, "t", "half", "p"), ("s", 8192, 8192, "t", "point", "p")]
    events = [(i, rng.choice(["s", "s", "s", "t", "u", None]), rng.randrange(-5000, 20000)) for i in range(600)] + [(600, "s", None), (601, "s", 8191), (602, "s", 8192)]
    named = "service string, start bigint, end bigint, trace_id string, span_id string, parent_span_id string"
    blank = [F.lit(None).cast("string").alias(n) for n in ("trace_id", "span_id", "parent_span_id")]
    rows = spark.createDataFrame(events, "event_id int, service string, at bigint").select("*", *blank)
    last = max(at for _, _, at in events if at is not None)
    for width, hot_rows in ((8192, 20), (10_000, 0), (100, 3), (50_000, 0), (8192, 300)):
        found = enrich.active_spans(rows, spark.createDataFrame(spans, named), width, hot_rows)
        got = {r.event_id: r.span_id for r in found.collect()}
        assert len(got) == len(events) == found.count()
        for i, service, at in events:
            open_now = [s for s in spans if at is not None and s[0] == service and s[1] <= at <= (last if s[2] is None else s[2])]
            assert got[i] == max(((s[1], s[4]) for s in open_now), default=(0, None))[1], (width, i)


def test_open_and_endless_spans(spark):
    spans = [("s", 10, None, "t1", "open", "p"), ("s", 20, 2**62, "t2", "endless", "p"), ("s", None, 30, "t3", "x", "p"), (None, 0, 100, "t4", "y", "p"), ("s", 25, 24, "t5", "z", "p")]
    events = [(1, "s", 5), (2, "s", 15), (3, "s", 7_200_000_000), (4, None, 15)]
    named = "service string, start bigint, end bigint, trace_id string, span_id string, parent_span_id string"
    blank = [F.lit(None).cast("string").alias(n) for n in ("trace_id", "span_id", "parent_span_id")]
    rows = spark.createDataFrame(events, "event_id long, service string, at long").select("*", *blank)
    found = enrich.active_spans(rows, spark.createDataFrame(spans, named))
    assert {r.event_id: r.span_id for r in found.collect()} == {1: None, 2: "open", 3: "endless", 4: None}
