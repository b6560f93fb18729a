"""Request, device, session, run and control-tag queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultrail.functions.devices import classify
from vaultrail.functions.jsontext import object_of, quote
from vaultrail.functions.metadata import guard
from vaultrail.functions.requests import (
    apply_policy,
    client_context,
    event_policy,
    normalise_headers,
    telemetry_policy,
    trace_context,
)
from vaultrail.operators import enrich, ingest
from vaultrail.operators.ordered import clock_terms, clock_value, int_chunk, logical_clock
from vaultrail.plans import inputs
from vaultrail.plans.inputs import KEYRING
from vaultrail.plans.oracle import AUDIT, REQUESTS, device, hmac, with_
from vaultrail.plans.registry import registrar

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)


def requests(spark, folder):
    """Requests with client and trace context."""
    rows = inputs.requests(spark, folder).withColumn("headers", normalise_headers("headers"))
    return rows.withColumns({"client": client_context("headers", "socket_addr"), "trace": trace_context("headers")})


@query(with_(REQUESTS) + "SELECT request_id, ip, ua AS user_agent, country, region, city FROM clients")
def client_contexts(spark, folder):
    return requests(spark, folder).select(
        "request_id", "client.ip", F.col("client.userAgent").alias("user_agent"), "client.location.country", "client.location.region", "client.location.city"
    )


@query(with_(REQUESTS) + "SELECT request_id, trace_id, span_id, logical_clock FROM clients")
def trace_contexts(spark, folder):
    return requests(spark, folder).select("request_id", "trace.trace_id", "trace.span_id", "trace.logical_clock")


def overrides():
    """Preset by the request number, and single fields on top."""
    r = F.col("r")
    return (
        F.when(r % 4 == 0, "strict").when(r % 4 == 1, "full").when(r % 4 == 2, "standard"),
        F.when(r % 5 == 0, "track").when(r % 5 == 1, "skip"),
        F.when(r % 6 == 0, "track").when(r % 6 == 1, "skip"),
        F.when(r % 7 == 0, F.lit(True)).when(r % 7 == 1, F.lit(False)),
    )


POLICY = """policies AS (SELECT *,
    COALESCE(CASE r % 5 WHEN 0 THEN 'track' WHEN 1 THEN 'skip' END, CASE r % 4 WHEN 0 THEN 'skip' WHEN 1 THEN 'track' ELSE 'anonymize' END) AS p_ip,
    COALESCE(CASE r % 6 WHEN 0 THEN 'track' WHEN 1 THEN 'skip' END, CASE r % 4 WHEN 0 THEN 'skip' WHEN 1 THEN 'track' ELSE 'parse' END) AS p_ua,
    COALESCE(CASE r % 7 WHEN 0 THEN true WHEN 1 THEN false END, r % 4 <> 0) AS p_loc FROM clients)"""


@query(
    with_(REQUESTS, POLICY)
    + f"""SELECT request_id, p_ip, p_ua, p_loc,
      CASE WHEN p_loc THEN country END AS country, CASE WHEN p_loc THEN region END AS region,
      CASE WHEN p_loc AND p_ip = 'track' THEN city END AS city,
      CASE WHEN ip = '' THEN NULL WHEN p_ip = 'anonymize' THEN {hmac('ip')} WHEN p_ip = 'track' THEN ip END AS ip,
      CASE WHEN p_ua <> 'skip' AND ua <> '' THEN {device('ua')['browser']} END AS browser,
      CASE WHEN p_ua = 'track' AND ua <> '' THEN ua END AS user_agent FROM policies"""
)
def telemetry_policies(spark, folder):
    """Presets with overrides, and what they let through of address, place and user agent."""
    none = F.lit(None).cast("struct<browser:string,os:string,type:string>")
    rows = KEYRING.attach(requests(spark, folder)).withColumn("policy", telemetry_policy(*overrides()))
    context = F.struct("client.ip", "client.userAgent", "client.location", none.alias("device"))
    rows = rows.withColumn("kept", apply_policy(context, F.col("policy"), F.col("_key"), F.lit(False), inputs.INGEST_AGENT))
    return rows.select(
        "request_id",
        F.col("policy.ip").alias("p_ip"),
        F.col("policy.user_agent").alias("p_ua"),
        F.col("policy.location").alias("p_loc"),
        "kept.location.country",
        "kept.location.region",
        "kept.location.city",
        "kept.ip",
        "kept.device.browser",
        F.col("kept.userAgent").alias("user_agent"),
    )


@query(
    with_(REQUESTS)
    + """SELECT request_id, CASE WHEN r % 5 = 0 THEN 'track' WHEN r % 5 = 1 THEN 'skip' ELSE 'anonymize' END AS p_ip,
      CASE WHEN r % 7 = 1 THEN NULL WHEN r % 4 = 1 OR r % 5 = 0 THEN city END AS city FROM clients"""
)
def event_telemetry(spark, folder):
    """An event's own preset changes no field of the base policy; "full" only opens the city."""
    preset, ip, ua, location = overrides()
    base = F.struct(F.lit("anonymize").alias("ip"), F.lit("parse").alias("user_agent"), F.lit(True).alias("location"))
    rows = KEYRING.attach(requests(spark, folder)).withColumn("policy", event_policy(base, preset, ip, ua, location))
    none = F.lit(None).cast("struct<browser:string,os:string,type:string>")
    context = F.struct("client.ip", "client.userAgent", "client.location", none.alias("device"))
    kept = apply_policy(context, F.col("policy"), F.col("_key"), preset == "full")
    return rows.select("request_id", F.col("policy.ip").alias("p_ip"), kept["location"]["city"].alias("city"))


@query(
    with_(REQUESTS)
    + f"""SELECT {device('ua')['browser']} AS browser, {device('ua')['os']} AS os, {device('ua')['type']} AS type, count(*) AS n
      FROM clients GROUP BY ALL"""
)
def device_breakdown(spark, folder):
    parsed = requests(spark, folder).select(classify("client.userAgent", inputs.INGEST_AGENT).alias("d"))
    return parsed.groupBy("d.browser", "d.os", "d.type").agg(F.count(F.lit(1)).alias("n"))


@query(
    with_(AUDIT, REQUESTS)
    + f"""SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '1.2.3.4' ELSE ip END AS ip, CASE WHEN event_id % 9 = 0 THEN 'CH' ELSE country END AS country,
      city, ua AS user_agent, COALESCE(c.logical_clock, 0) AS clock_base FROM audit a JOIN clients c USING (request_id)"""
)
def request_enrich(spark, folder):
    """Request context below the event's own."""
    own = F.when(
        F.col("event_id") % 9 == 0,
        F.struct(
            F.lit("1.2.3.4").alias("ip"),
            F.lit(None).cast("string").alias("userAgent"),
            F.struct(F.lit("CH").alias("country"), F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("city")).alias("location"),
            F.lit(None).cast("struct<browser:string,os:string,type:string>").alias("device"),
        ),
    )
    events = inputs.audit(spark, folder).select("event_id", "request_id", own.alias("context"))
    rows = enrich.attach_requests(events, requests(spark, folder))
    return rows.select("event_id", "context.ip", "context.location.country", "context.location.city", F.col("context.userAgent").alias("user_agent"), "clock_base")


@query(
    with_(AUDIT)
    + """SELECT event_id, COALESCE(actor, CASE WHEN user_id % 9 <> 0 THEN 'session_' || user_id END) AS actor,
      CASE WHEN user_id % 9 <> 0 THEN '{"email":"u' || user_id || '@example.com","k":' || k || '}' ELSE metadata END AS metadata FROM audit"""
)
def identity_enrich(spark, folder):
    """Actor and metadata from the session; the event's own metadata wins."""
    user = F.col("user_id")
    sessions = inputs.users(spark, folder).where(user % 9 != 0).select(
        "user_id",
        inputs.text("session_", user).alias("session_actor"),
        object_of(("email", quote(inputs.text("u", user, "@example.com"))), ("k", F.lit("-1"))).alias("session_metadata"),
    )
    rows = enrich.attach_sessions(inputs.audit(spark, folder), sessions)
    return rows.select("event_id", "actor", guard("metadata")["metadata"].alias("metadata"))


@query(
    with_(AUDIT)
    + """SELECT event_id, COALESCE(trace_id, CASE WHEN user_id % 4 <> 0 THEN 'rt_' || user_id END) AS trace_id,
      COALESCE(span_id, CASE WHEN user_id % 4 <> 0 THEN 'rs_' || user_id END) AS span_id,
      COALESCE(rationale, CASE WHEN user_id % 4 <> 0 THEN 'run of ' || user_id END) AS rationale,
      COALESCE(tool_name, CASE WHEN user_id % 4 <> 0 AND user_id % 3 = 0 THEN 'planner' END) AS tool_name FROM audit"""
)
def run_context(spark, folder):
    user = F.col("user_id")
    runs = inputs.users(spark, folder).where(user % 4 != 0).select(
        inputs.text("run_", user).alias("run_id"),
        inputs.text("rt_", user).alias("run_trace_id"),
        inputs.text("rs_", user).alias("run_span_id"),
        inputs.text("run of ", user).alias("run_rationale"),
        F.when(user % 3 == 0, "planner").otherwise("").alias("run_tool_name"),
    )
    rows = enrich.attach_runs(inputs.audit(spark, folder), runs)
    return rows.select("event_id", "trace_id", "span_id", "rationale", "tool_name")


COMPLIANCE_BY_TYPE = {
    "signup": "access.granted",
    "purchase": "data.exported",
    "error": "system.config_changed",
    "view": "mfa.enabled",
}


@query(
    with_(AUDIT)
    + """SELECT event_id, c.action, '{"k":' || k || ',"soc2_control":"' || soc2 || '","iso27001":"' || iso || '"}' AS metadata
      FROM audit JOIN (VALUES ('event.signup', 'access.granted', 'CC6.1', 'A.9.2.1'), ('event.purchase', 'data.exported', 'CC6.6', 'A.12.4.1'),
        ('event.error', 'system.config_changed', 'CC6.2', 'A.12.1.2'), ('event.view', 'mfa.enabled', 'CC6.3', 'A.9.4.2')) c(event, action, soc2, iso)
      ON audit.action = c.event"""
)
def compliance_tags(spark, folder):
    """Control tags of compliance actions; a control the event brings along is replaced."""
    action = F.col("action")
    for kind, name in COMPLIANCE_BY_TYPE.items():
        action = F.when(F.col("action") == f"event.{kind}", name).otherwise(action)
    own = F.when(F.col("event_id") % 5 == 0, F.concat(F.regexp_replace("metadata", r"\}$", ""), F.lit(',"soc2_control":"own"}')))
    events = inputs.audit(spark, folder).withColumns({"action": action, "metadata": F.coalesce(own, "metadata")})
    return enrich.tag_compliance(events).select("event_id", "action", guard("metadata")["metadata"].alias("metadata"))


AGENT_KINDS = ["toolCall", "decision", "escalation", "anomaly", "refusal", "handoff"]


TAXONOMY = """taxonomy(kind, action, eu, nist, soc2, iso) AS (SELECT * FROM (VALUES (0, 'agent.tool_call', 'Article 12', 'MANAGE 2.2', 'CC6.6', 'A.12.4.1'),
    (1, 'agent.decision', 'Article 12 & 13', 'GOVERN 1.7', 'CC6.2', 'A.18.1.3'), (2, 'agent.escalation', 'Article 14', 'GOVERN 5.1', 'CC6.3', 'A.6.1.2'),
    (3, 'agent.anomaly', 'Article 9', 'MANAGE 2.4', 'CC7.2', 'A.16.1.2'), (4, 'agent.refusal', 'Article 5', 'GOVERN 1.1', 'CC6.8', 'A.18.1.3'),
    (5, 'agent.handoff', 'Article 12', 'MAP 1.6', 'CC6.6', 'A.12.4.1')))"""


@query(
    with_(AUDIT, TAXONOMY)
    + """SELECT event_id, c.action, '{"k":' || k || ',"reason":"' || target || '","eu_ai_act":"' || eu || '","nist_ai_rmf":"' || nist
        || '","soc2_control":"' || soc2 || '","iso27001":"' || iso || '"}' AS metadata
      FROM audit JOIN taxonomy c ON event_id % 6 = c.kind"""
)
def agent_taxonomy(spark, folder):
    kinds = F.array(*[F.lit(k) for k in AGENT_KINDS])
    events = inputs.audit(spark, folder).drop("action").withColumns(
        {
            "kind": F.element_at(kinds, (F.col("event_id") % 6 + 1).cast("int")),
            "fields": object_of(("reason", quote("target"))),
        }
    )
    return enrich.tag_agent_events(events).select("event_id", "action", "metadata")


@query(
    with_(AUDIT, TAXONOMY)
    + """SELECT event_id, c.action, '{"k":' || k || ',"reason":"' || target || '"' || COALESCE(',"rationale":"' || rationale || '"', '')
        || COALESCE(',"toolName":"' || tool_name || '"', '') || COALESCE(',"logicalClock":' || logical_clock, '')
        || CASE WHEN event_id % 5 = 0 THEN ',"attestation":{"challenge":"c' || event_id || '"}' ELSE '' END || ',"eu_ai_act":"' || eu
        || '","nist_ai_rmf":"' || nist || '","soc2_control":"' || soc2 || '","iso27001":"' || iso || '"}' AS metadata, true AS moved
      FROM audit JOIN taxonomy c ON event_id % 6 = c.kind"""
)
def agent_extras(spark, folder):
    """Rationale, tool, clock and attestation of agent events go to their metadata and are no fields of their own."""
    kinds = F.array(*[F.lit(k) for k in AGENT_KINDS])
    given = F.when(F.col("event_id") % 5 == 0, F.struct(inputs.text("c", F.col("event_id")).alias("challenge")))
    events = inputs.audit(spark, folder).drop("action").withColumns(
        {
            "kind": F.element_at(kinds, (F.col("event_id") % 6 + 1).cast("int")),
            "fields": object_of(("reason", quote("target"))),
            "attestation": given,
        }
    )
    rows = enrich.tag_agent_events(enrich.move_agent_context(events))
    moved = F.coalesce("rationale", "tool_name", F.col("logical_clock").cast("string"), "attestation.challenge").isNull()
    return rows.select("event_id", "action", "metadata", moved.alias("moved"))


@query(
    with_(
        AUDIT,
        REQUESTS,
        """spans AS (SELECT 'svc_' || (user_id % 5) AS service, epoch_us(ts) AS s, epoch_us(ts) + ((event_id * 37) % 600 + 1) * 60000000 AS e, event_id
          FROM events)""",
        """timed AS (SELECT event_id, 'svc_' || (user_id % 5) AS service, epoch_us(ts) AS at FROM events)""",
        """found AS (SELECT t.event_id, s.event_id AS span FROM timed t JOIN spans s ON s.service = t.service AND t.at BETWEEN s.s AND s.e
          QUALIFY row_number() OVER (PARTITION BY t.event_id ORDER BY s.s DESC, s.event_id DESC) = 1)""",
    )
    + """SELECT t.event_id, CASE WHEN t.event_id % 10 = 0 THEN 'own' ELSE 'tr_' || span END AS trace_id, 'sp_' || span AS span_id,
      'sp_' || (span // 2) AS parent_span_id FROM timed t LEFT JOIN found USING (event_id)"""
)
def active_span(spark, folder):
    """Trace, span and parent from the innermost span open when the event happened."""
    rows = enrich.active_spans(inputs.timed_events(spark, folder), inputs.timed_spans(spark, folder))
    return rows.select("event_id", "trace_id", "span_id", "parent_span_id")


@query(
    with_(
        AUDIT,
        REQUESTS,
        """spans AS (SELECT 'svc_' || (user_id % 5) AS service, epoch_us(ts) AS s, epoch_us(ts) + ((event_id * 37) % 600 + 1) * 60000000 AS e, event_id
          FROM events)""",
        """timed AS (SELECT event_id, user_id, 'svc_' || (user_id % 7) AS service, epoch_us(ts) AS at FROM events)""",
        """found AS (SELECT t.event_id, s.event_id AS span FROM timed t JOIN spans s ON s.service = t.service AND t.at BETWEEN s.s AND s.e
          QUALIFY row_number() OVER (PARTITION BY t.event_id ORDER BY s.s DESC, s.event_id DESC) = 1)""",
    )
    + """SELECT t.event_id, CASE WHEN t.event_id % 10 = 0 THEN 'own' ELSE COALESCE('tr_' || span, CASE WHEN user_id % 4 <> 0 THEN 'rt_' || user_id END, c.trace_id) END AS trace_id,
      COALESCE('sp_' || span, CASE WHEN user_id % 8 > 4 THEN 'rs_' || user_id END, c.span_id) AS span_id
      FROM timed t LEFT JOIN found USING (event_id) JOIN clients c ON c.request_id = 'r_' || (t.event_id // 7)"""
)
def trace_precedence(spark, folder):
    """Trace and span from event, active span, agent run and request header, in this order; some services have no spans."""
    user, none = F.col("user_id"), F.lit(None)
    events = inputs.audit(spark, folder).select("event_id", "user_id", "request_id", "run_id").join(inputs.timed_events(spark, folder), "event_id")
    events = events.withColumns(
        {
            "service": inputs.text("svc_", user % 7),
            "rationale": none.cast("string"),
            "tool_name": none.cast("string"),
            "context": none.cast(ingest.AUDIT_EVENT["context"]),
        }
    )
    runs = inputs.users(spark, folder).select(
        inputs.text("run_", user).alias("run_id"),
        F.when(user % 4 != 0, inputs.text("rt_", user)).alias("run_trace_id"),
        F.when(user % 8 > 4, inputs.text("rs_", user)).otherwise("").alias("run_span_id"),
        none.cast("string").alias("run_rationale"),
        none.cast("string").alias("run_tool_name"),
    )
    rows = enrich.resolve_trace(events, inputs.timed_spans(spark, folder), runs, requests(spark, folder))
    return rows.select("event_id", "trace_id", "span_id")


CLOCK_FOLD = """ordered AS (SELECT request_id, event_id, logical_clock AS inc, row_number() OVER (PARTITION BY request_id ORDER BY event_id) AS n FROM audit),
  fold AS (
    SELECT o.request_id, o.event_id, o.n, greatest(COALESCE(c.logical_clock, 0), COALESCE(o.inc, 0)) + 1 AS clock
    FROM ordered o JOIN clients c USING (request_id) WHERE n = 1
    UNION ALL
    SELECT o.request_id, o.event_id, o.n, greatest(f.clock, COALESCE(o.inc, 0)) + 1
    FROM fold f JOIN ordered o ON o.request_id = f.request_id AND o.n = f.n + 1)"""


@query(with_(AUDIT, REQUESTS, CLOCK_FOLD, recursive=True) + "SELECT event_id, clock AS logical_clock FROM fold")
def lamport_clock(spark, folder):
    """Clocks per request, starting at the request's own clock."""
    events = inputs.audit(spark, folder).select("event_id", "request_id", F.lit(None).cast(ingest.AUDIT_EVENT["context"]).alias("context"), "logical_clock")
    terms = clock_terms(events, ["request_id"], ["event_id"], [int_chunk("event_id")], F.col("logical_clock"))
    rows = enrich.attach_requests(terms, requests(spark, folder))
    return rows.select("event_id", clock_value(F.col("clock_base")).alias("logical_clock"))


@query(
    with_(
        """ordered AS (SELECT user_id % 3 AS scope, event_id, CASE WHEN event_id % 6 = 0 THEN event_id % 400 ELSE 0 END AS inc,
          row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) AS n FROM events)"""
    )
    + """SELECT event_id, n + max(inc - n + 1) OVER (PARTITION BY scope ORDER BY n ROWS UNBOUNDED PRECEDING) AS logical_clock
      FROM ordered"""
)
def lamport_clock_hot(spark, folder):
    """Clocks of three scopes that share the whole table; each is treated as hot and divided into chunks of 500 rows."""
    e = F.col("event_id")
    events = inputs.table(spark, folder, "events").select("event_id", (F.col("user_id") % 3).alias("scope"))
    clocked = logical_clock(events, ["scope"], ["event_id"], [int_chunk("event_id", 500)], F.when(e % 6 == 0, e % 400), F.lit(0), hot_rows=100)
    return clocked.select("event_id", "logical_clock")
