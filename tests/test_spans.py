import json

from pyspark.sql import functions as F

from vaultrail.functions.jsontext import object_of, quote
from vaultrail.functions.metadata import guard
from vaultrail.operators import spans

MAP = "map<string,string>"
AUDIT = {"vaultrail.payload": '{"action":"login","actor":{"id":"u","pii":"p"},"targetId":"t","metadata":{"n":1,"o":{"b":1,"a":2}},"logicalClock":7}'}


def test_explicit_wins_and_broken_falls_back(spark):
    rows = [
        ("t", "both", "par", {"vaultrail.action": "generic", "audit.action": "second"}),
        ("t", "broken", None, {"audit.action": "fallback", "audit.actor": "me", "x": "y"}),
        ("t", "neither", None, {"x": "y"}),
        ("t", "empty", None, {"vaultrail.action": "", "audit.action": "used"}),
    ]
    frame = spark.createDataFrame(rows, f"trace_id string, span_id string, parent_span_id string, attributes {MAP}")
    nested = spark.createDataFrame(
        [
            ("t", "both", [("vaultrail.audit", AUDIT), ("other", AUDIT), ("vaultrail.audit", {"vaultrail.payload": '{"action":"again","actor":"plain"}'})]),
            ("t", "broken", [("vaultrail.audit", {"vaultrail.payload": "{bad"}), ("vaultrail.audit", {"vaultrail.payload": "[1]"}), ("vaultrail.audit", {})]),
            ("t", "neither", []),
        ],
        f"trace_id string, span_id string, events array<struct<name:string,attributes:{MAP}>>",
    )
    found = spans.span_audit_events(frame, spans.explode_span_events(nested)).collect()
    assert sorted((r.source, r.action) for r in found) == [("explicit", "again"), ("explicit", "login"), ("generic", "fallback"), ("generic", "used")]
    by = {r.action: r for r in found}
    assert by["login"].actor is None and tuple(by["login"].actor_ref) == ("u", "p") and by["login"].target == "t" and by["login"].logical_clock == 7
    assert by["login"].metadata == '{"n":1,"o":{"b":1,"a":2}}'
    assert by["again"].actor == "plain" and by["again"].actor_ref is None and by["again"].metadata == "{}"
    assert by["fallback"].actor == "me" and by["fallback"].span_id == "broken" and json.loads(by["fallback"].metadata)["x"] == "y"
    assert by["used"].actor == "unknown"


def test_log_records(spark):
    rows = [(1, "t", "s", "hello \"x\"", {"vaultrail.action": "a", "audit.actor": "me"}), (2, "t", "s", "b", AUDIT), (3, "t", "s", None, {"vaultrail.payload": "{bad", "audit.action": "f"}), (4, "t", "s", "b", {"k": "v"}), (5, "t", "s", "b", None)]
    frame = spark.createDataFrame(rows, f"n int, trace_id string, span_id string, body string, attributes {MAP}")
    found = {r.n: r for r in spans.log_audit_events(frame, keep=["n"]).withColumn("metadata", guard("metadata")["metadata"]).collect()}
    assert sorted(found) == [1, 2, 3]
    assert json.loads(found[1].metadata) == {"vaultrail.action": "a", "audit.actor": "me", "body": 'hello "x"'} and found[1].actor == "me"
    assert found[2].source == "explicit" and found[2].trace_id is None
    assert found[3].action == "f" and "body" not in json.loads(found[3].metadata)


def test_own_prefix(spark):
    frame = spark.createDataFrame([("t", "s", None, {"acme.action": "a"})], f"trace_id string, span_id string, parent_span_id string, attributes {MAP}")
    none = spark.createDataFrame([], f"trace_id string, span_id string, name string, attributes {MAP}")
    assert [r.action for r in spans.span_audit_events(frame, none, prefix="acme").collect()] == ["a"]
    assert spans.span_audit_events(frame, none).count() == 0


def test_redirect(spark):
    events = spark.createDataFrame([(1, "t", "s", "a"), (2, "t", "zz", "b"), (3, None, None, "c"), (4, "t", "s", "d")], "event_id int, trace_id string, span_id string, action string")
    known = spark.createDataFrame([("t", "s"), ("t", "s")], "trace_id string, span_id string")
    attached, direct = spans.redirect_to_spans(events, known, object_of(("action", quote("action"))))
    assert sorted((r.event_id, r.attributes["vaultrail.payload"]) for r in attached.collect()) == [(1, '{"action":"a"}'), (4, '{"action":"d"}')]
    assert sorted(r.event_id for r in direct.collect()) == [2, 3]
    back = spans.span_audit_events(
        known.dropDuplicates().withColumns({"parent_span_id": F.lit(None).cast("string"), "attributes": F.lit(None).cast(MAP)}), attached
    )
    assert sorted(r.action for r in back.collect()) == ["a", "d"]
