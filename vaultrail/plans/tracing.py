"""Span, log-record and causality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultrail.functions.jsontext import object_of, quote
from vaultrail.functions.numbers import floor_div
from vaultrail.operators import search
from vaultrail.operators import spans as tracing
from vaultrail.operators.ordered import int_chunk, logical_clock
from vaultrail.plans import inputs
from vaultrail.plans.oracle import AUDIT, with_
from vaultrail.plans.registry import registrar

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)


@query(
    """SELECT 'explicit' AS source, 'line.R' AS action, 'supp_' || l_suppkey AS actor, NULL::VARCHAR AS target, 'p_' || l_partkey AS target_ref,
      'tr_' || (l_orderkey // 50) AS trace_id, NULL::VARCHAR AS span_id, NULL::VARCHAR AS parent_span_id, '{"line":' || l_linenumber || '}' AS metadata
      FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL
    SELECT 'generic', 'order.' || o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'cust_' || o_custkey ELSE 'unknown' END,
      CASE o_orderstatus WHEN 'O' THEN 'ord_' || o_orderkey END, NULL, 'tr_' || (o_orderkey // 50), 'sp_' || o_orderkey,
      CASE WHEN o_orderkey % 50 <> 0 THEN 'sp_' || (o_orderkey - 1) END,
      CASE o_orderstatus WHEN 'F' THEN '{"audit.action":"order.F","audit.actor":"cust_' || o_custkey || '","priority":"' || o_orderpriority || '"}'
        ELSE '{"vaultrail.action":"order.O","vaultrail.target":"ord_' || o_orderkey || '","priority":"' || o_orderpriority || '"}' END
      FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
)
def span_events_union(spark, folder):
    """Explicit events of spans, and annotated spans that have none."""
    rows = tracing.span_audit_events(inputs.spans(spark, folder), inputs.span_events(spark, folder))
    return rows.select(
        "source", "action", "actor", "target", F.col("target_ref.id").alias("target_ref"), "trace_id", "span_id", "parent_span_id", "metadata"
    )


@query(
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'explicit' ELSE 'generic' END AS source,
      CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'seen' END AS action,
      CASE event_type WHEN 'error' THEN 'unknown' ELSE 'usr_' || user_id END AS actor,
      CASE event_type WHEN 'purchase' THEN 'own' ELSE 'tr_' || (event_id // 7) END AS trace_id,
      CASE event_type WHEN 'purchase' THEN '{"n":' || event_id || '}'
        WHEN 'error' THEN '{"vaultrail.payload":"{broken","audit.action":"failed","body":' || to_json(props)::VARCHAR || '}'
        ELSE '{"vaultrail.action":"seen","audit.actor":"usr_' || user_id || '","body":' || to_json(props)::VARCHAR || '}' END AS metadata
      FROM events WHERE event_type IN ('purchase', 'error', 'view')"""
)
def log_records(spark, folder):
    """Log records: explicit payloads, broken ones that fall back to attributes, and annotated ones."""
    user, e, kind = inputs.text("usr_", F.col("user_id")), F.col("event_id"), F.col("event_type")
    payload = inputs.text('{"action":"buy","actor":"', user, '","traceId":"own","metadata":{"n":', e, "}}")
    pairs = [
        ("vaultrail.payload", F.when(kind == "purchase", payload).when(kind == "error", F.lit("{broken"))),
        ("vaultrail.action", F.when(kind == "view", "seen")),
        ("audit.action", F.when(kind == "error", "failed")),
        ("audit.actor", F.when(kind == "view", user)),
        ("level", F.when(kind == "click", "info")),
    ]
    every = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[v for _, v in pairs]))
    logs = inputs.table(spark, folder, "events").select(
        "event_id",
        inputs.text("tr_", floor_div("event_id", 7)).alias("trace_id"),
        inputs.text("sp_", e).alias("span_id"),
        F.col("props").alias("body"),
        F.map_filter(every, lambda _, v: v.isNotNull()).alias("attributes"),
    )
    rows = tracing.log_audit_events(logs, keep=["event_id"])
    return rows.select("event_id", "source", "action", "actor", "trace_id", "metadata")


@query(
    with_(AUDIT)
    + """SELECT event_id, CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN 'span' ELSE 'ledger' END AS destination,
      CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0
        THEN '{"action":"' || action || '","target":"' || target || '","metadata":' || metadata || '}' END AS payload FROM audit"""
)
def span_redirect(spark, folder):
    """Events with a known span become span events, the others go to the ledger."""
    events = inputs.audit(spark, folder)
    payload = object_of(("action", quote("action")), ("target", quote("target")), ("metadata", F.col("metadata")))
    attached, direct = tracing.redirect_to_spans(events, events.where("trace_id IS NOT NULL AND span_id IS NOT NULL"), payload)
    return attached.select(
        "event_id", F.lit("span").alias("destination"), F.col("attributes")["vaultrail.payload"].alias("payload")
    ).unionByName(direct.select("event_id", F.lit("ledger").alias("destination"), F.lit(None).cast("string").alias("payload")))


@query(
    """SELECT 'sp_' || o_orderkey AS span_id, 'sp_' || (o_orderkey // 50 * 50) AS root_span_id, o_orderkey % 50 AS depth,
      row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY o_orderkey) AS logical_clock FROM orders"""
)
def causal_tree(spark, folder):
    """Root and depth of every span, ordered by trace and clock."""
    rows = search.causality(inputs.spans(spark, folder), ["trace_id"])
    clocked = logical_clock(rows, ["trace_id"], ["order_key"], [int_chunk("order_key")], F.lit(0), F.lit(0))
    ordered = search.causal_order(clocked.withColumn("event_id", F.col("order_key")), ["trace_id"])
    return ordered.select("span_id", "root_span_id", "depth", "logical_clock")
