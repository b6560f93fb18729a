"""Joins that fill in events: request context, sessions, agent runs, spans and control tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultrail.functions.jsontext import object_of, quote, splice
from vaultrail.functions.numbers import floor_div
from vaultrail.functions.text import first_present, present
from vaultrail.operators.ordered import HOT_ROWS
from vaultrail.session import remove_folder, work_folder

# Compliance actions with their SOC 2 and ISO 27001 controls.
COMPLIANCE_CONTROLS = [
    ("access.revoked", "CC6.1", "A.9.2.6"),
    ("access.granted", "CC6.1", "A.9.2.1"),
    ("data.exported", "CC6.6", "A.12.4.1"),
    ("system.config_changed", "CC6.2", "A.12.1.2"),
    ("mfa.enabled", "CC6.3", "A.9.4.2"),
]

# Agent event kinds with action, EU AI Act, NIST AI RMF, SOC 2 and ISO 27001 references.
AGENT_CONTROLS = [
    ("toolCall", "agent.tool_call", "Article 12", "MANAGE 2.2", "CC6.6", "A.12.4.1"),
    ("decision", "agent.decision", "Article 12 & 13", "GOVERN 1.7", "CC6.2", "A.18.1.3"),
    ("escalation", "agent.escalation", "Article 14", "GOVERN 5.1", "CC6.3", "A.6.1.2"),
    ("anomaly", "agent.anomaly", "Article 9", "MANAGE 2.4", "CC7.2", "A.16.1.2"),
    ("refusal", "agent.refusal", "Article 5", "GOVERN 1.1", "CC6.8", "A.18.1.3"),
    ("handoff", "agent.handoff", "Article 12", "MAP 1.6", "CC6.6", "A.12.4.1"),
]


# Fixed value: metadata limit of agent events, in characters.
AGENT_METADATA_LIMIT = 5_242_880


def compliance_controls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COMPLIANCE_CONTROLS, "action string, soc2_control string, iso27001 string")


def agent_controls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        AGENT_CONTROLS,
        "kind string, action string, eu_ai_act string, nist_ai_rmf string, soc2_control string, iso27001 string",
    )


def tag_compliance(events: DataFrame) -> DataFrame:
    """Keep the compliance actions and put their controls over the event's metadata.

    The control table has five fixed rows, which is why it may be broadcast.
    """
    tagged = events.join(F.broadcast(compliance_controls(events.sparkSession)), "action")
    tags = F.to_json(F.struct("soc2_control", "iso27001"))
    return tagged.withColumn("metadata", splice("metadata", tags))


def tag_agent_events(events: DataFrame, kind: str = "kind", fields: str = "fields") -> DataFrame:
    """Action and control tags of agent events.

    Metadata, then the kind's own ``fields``, then the controls: on a name clash the later one wins. The control table
    has six fixed rows.
    """
    controls = agent_controls(events.sparkSession).withColumnRenamed("kind", kind)
    tagged = events.join(F.broadcast(controls), kind)
    tags = F.to_json(F.struct("eu_ai_act", "nist_ai_rmf", "soc2_control", "iso27001"))
    limit = F.lit(AGENT_METADATA_LIMIT).cast("bigint")
    return tagged.withColumns({"metadata": splice("metadata", fields, tags), "max_meta": limit})


def move_agent_context(events: DataFrame, fields: str = "fields") -> DataFrame:
    """Put rationale, tool name, clock and attestation of agent events among their ``fields``.

    For agent events these are metadata: they enter neither the sealed agent context nor the clock.
    """
    moved = {"rationale": quote("rationale"), "toolName": quote("tool_name"), "logicalClock": F.col("logical_clock").cast("string")}
    parts = object_of(*moved.items(), ("attestation", F.to_json("attestation")))
    none = {n: F.lit(None).cast(events.schema[n].dataType) for n in ("rationale", "tool_name", "logical_clock", "attestation")}
    return events.withColumn(fields, splice(fields, parts)).withColumns(none)


def merge_context(outer: Column, inner: Column) -> Column:
    """Field-wise merge of two ``struct<ip, userAgent, location, device>`` values; ``inner`` wins."""

    def both(name: str, part: str) -> Column:
        return F.coalesce(inner[name][part], outer[name][part]).alias(part)

    return F.struct(
        F.coalesce(inner["ip"], outer["ip"]).alias("ip"),
        F.coalesce(inner["userAgent"], outer["userAgent"]).alias("userAgent"),
        F.struct(*[both("location", p) for p in ("country", "region", "city")]).alias("location"),
        F.struct(*[both("device", p) for p in ("browser", "os", "type")]).alias("device"),
    )


def attach_requests(events: DataFrame, requests: DataFrame) -> DataFrame:
    """Every event of a request gets the request's context and clock base.

    ``requests`` has one row per ``request_id`` with ``client`` and ``trace`` structs. A request that owns much of the
    table is split by adaptive skew handling, since nothing after the join needs its rows together.
    """
    scope = requests.select("request_id", "client", F.coalesce("trace.logical_clock", F.lit(0)).alias("clock_base"), "trace")
    device = F.lit(None).cast("struct<browser:string,os:string,type:string>")
    joined = events.join(scope, "request_id", "left")
    outer = F.struct("client.ip", "client.userAgent", "client.location", device.alias("device"))
    return joined.withColumn("context", merge_context(outer, F.col("context"))).withColumn(
        "clock_base", F.coalesce("clock_base", F.lit(0))
    )


def attach_sessions(events: DataFrame, sessions: DataFrame, user: str = "user_id") -> DataFrame:
    """Actor from the session where the event names none; session metadata below the event's.

    ``sessions`` has one row per user with ``session_actor`` and ``session_metadata`` (JSON object text). An event
    without a session stays as it is.
    """
    joined = events.join(sessions.select(user, "session_actor", "session_metadata"), user, "left")
    return joined.withColumns(
        {
            "actor": first_present("actor", "session_actor"),
            "metadata": F.when(
                F.col("session_metadata").isNotNull(), splice("session_metadata", "metadata")
            ).otherwise(F.col("metadata")),
        }
    ).drop("session_actor", "session_metadata")


def attach_runs(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Blank trace, span, rationale and tool of an event come from its enclosing agent run.

    ``runs`` has one row per ``run_id`` with ``run_trace_id``, ``run_span_id``, ``run_rationale`` and ``run_tool_name``.
    """
    names = ["trace_id", "span_id", "rationale", "tool_name"]
    joined = events.join(runs.select("run_id", *[f"run_{n}" for n in names]), "run_id", "left")
    return joined.withColumns({n: first_present(n, f"run_{n}") for n in names}).drop(*[f"run_{n}" for n in names])


# --- span active at event time ---------------------------------------------------------------------------------------

_CHANGES = "service string, bucket bigint, part bigint, at bigint, step bigint, trace_id string, span_id string, parent_span_id string"
_NAMES = ["trace_id", "span_id", "parent_span_id"]
# A bucket that is too large has up to 2^LEVELS parts.
LEVELS = 12


def _innermost(batches):
    """Times at which the innermost open span changes, from spans sorted by service, bucket, part, start and id.

    Among open spans the innermost is the one that started last. A span that ends no later than a span started after
    it can never be innermost again once that one has started, so open spans form a stack with falling ends. Only this
    stack is held.
    """
    import pandas as pd

    columns = [part.split()[0] for part in _CHANGES.split(", ")]
    group, stack, step = None, [], 0

    def change(at, span):
        nonlocal step
        step += 1
        named = (None, None, None) if span is None else (span.trace_id, span.span_id, span.parent_span_id)
        return (*group, at, step, *named)

    def closed_before(time):
        while stack and stack[-1].end < time:
            ended = stack.pop()
            yield change(ended.end + 1, stack[-1] if stack else None)

    for frame in batches:
        rows = []
        for span in frame.itertuples(index=False):
            if (span.service, span.bucket, span.part) != group:
                if group is not None:
                    rows.extend(closed_before(float("inf")))
                group = (span.service, span.bucket, span.part)
            begin = max(span.start, span.floor)
            rows.extend(closed_before(begin))
            while stack and stack[-1].end <= span.end:
                stack.pop()
            stack.append(span)
            rows.append(change(begin, span))
        yield pd.DataFrame(rows, columns=columns)
    if group is not None:
        yield pd.DataFrame(list(closed_before(float("inf"))), columns=columns)


def _whole_nodes() -> Column:
    """Nodes of a binary tree over the parts of a bucket that together are the parts ``_a`` to ``_b``, at most two a level.

    Node ``i`` of level ``l`` has the parts from ``i * 2^l`` on. A node is taken if it lies inside and the one above it does not.
    """

    def lowest(level: str) -> str:
        return f"shiftright(_a + shiftleft(1L, {level}) - 1, {level})"

    def highest(level: str) -> str:
        return f"(shiftright(_b + 1, {level}) - 1)"

    inside = f"i >= {lowest('l')} and i <= {highest('l')}"
    above = f"l < {LEVELS} and i div 2 >= {lowest('(l + 1)')} and i div 2 <= {highest('(l + 1)')}"
    ends = f"array_distinct(array({lowest('l')}, {highest('l')}))"
    taken = f"transform(filter({ends}, i -> {inside} and not ({above})), i -> struct(l as level, i as node))"
    return F.expr(f"flatten(transform(sequence(0, {LEVELS}), l -> {taken}))")


def _divide(covered: DataFrame, rows: DataFrame, hot: DataFrame, bucket_micros: int) -> tuple[DataFrame, DataFrame]:
    """Divide ``hot`` buckets into parts of equal time: spans by the parts they touch, events by the part of their time.

    A span goes itself only to the parts in which it starts or ends. Of all spans that are open throughout a part, only the one that
    started last can be innermost there: such spans are reduced to one per tree node, and each part that has events takes the
    best of the nodes above it. So a span costs two rows and two nodes a level, however many parts it is open in.
    """
    key = ["service", "bucket"]
    width = -(-bucket_micros // 2**LEVELS)
    hot = hot.select(*key, F.lit(True).alias("_hot"))
    rows = rows.join(hot, key, "left")
    inside = floor_div(F.col("at") - F.col("bucket") * F.lit(bucket_micros), width)
    rows = rows.withColumn("part", F.when(F.col("_hot"), inside).otherwise(F.col("part"))).drop("_hot")

    marked = covered.join(hot, key, "left")
    plain = marked.where("_hot is null").drop("_hot")
    local = marked.where("_hot").drop("_hot").withColumns(
        {
            "_s": F.greatest("start", "floor") - F.col("floor"),
            "_e": F.least(F.col("end"), F.col("floor") + F.lit(bucket_micros - 1)) - F.col("floor"),
        }
    )
    lo, hi = floor_div(F.col("_s"), width), floor_div(F.col("_e"), width)
    # The last part may be shorter than the others.
    upto = F.when(F.col("_e") == bucket_micros - 1, hi).otherwise(floor_div(F.col("_e") + 1, width) - 1)
    local = local.withColumns({"_a": floor_div(F.col("_s") + (width - 1), width), "_b": upto})

    edges = F.array_distinct(F.array_compact(F.array(F.when(lo < F.col("_a"), lo), F.when(hi > F.col("_b"), hi))))
    partial = local.withColumn("part", F.explode(edges))
    span = F.struct("start", "span_id", "trace_id", "parent_span_id", "end").alias("_span")
    nodes = local.where("_a <= _b").select(*key, F.explode(_whole_nodes()).alias("_n"), span)
    best = nodes.groupBy(*key, "_n.level", "_n.node").agg(F.max("_span").alias("_span"))
    spots = rows.where("part >= 0").select(*key, "part").distinct()
    asked = spots.select("*", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level"))
    asked = asked.withColumn("node", F.expr("shiftright(part, level)"))
    whole = asked.join(best, [*key, "level", "node"]).groupBy(*key, "part").agg(F.max("_span").alias("_span"))
    whole = whole.select(*key, "part", "_span.*", (F.col("bucket") * F.lit(bucket_micros)).alias("floor"))
    columns = [*key, "part", "start", "end", *_NAMES, "floor"]
    parts = partial.select(*columns).unionByName(whole.select(*columns))
    parts = parts.withColumn("floor", F.col("floor") + F.col("part") * F.lit(width))
    return plain.select(*columns).unionByName(parts), rows


def active_spans(
    events: DataFrame, spans: DataFrame, bucket_micros: int = 3_600_000_000, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Blank trace, span and parent of an event come from the innermost span open at its time in its service.

    ``events`` and ``spans`` carry ``service`` and integer microseconds (``at``; ``start`` and ``end``, both ends
    included). No event meets a list of spans: the spans of a (service, time bucket) are first reduced to the moments
    at which the innermost one changes, and each event then takes the last change before it. A busy service is spread
    over its buckets, and a bucket with more than ``hot_rows`` events and spans over up to ``2^LEVELS`` parts. Such
    buckets are found by a count beforehand; where there are none, the plan has no trace of them.

    A span without an end is open until further notice. Spans are looked at only as far as the events reach, so an
    end in the far future costs nothing. A span without a start or a service, and one that ends before it starts, is
    active at no time. Among spans of equal start the one of the highest id counts as innermost.
    """

    def bucket(name: str) -> Column:
        return floor_div(name, bucket_micros)

    spark = events.sparkSession
    # One value for the plan, from a scan of the time column alone; spans are not joined with it.
    reach = events.agg(F.struct(F.min("at").alias("first"), F.max("at").alias("last"))).scalar()
    near = spans.where("service is not null and start is not null")
    near = near.withColumns({"_first": reach["first"], "_last": reach["last"]})
    near = near.withColumn("end", F.least(F.coalesce("end", "_last"), "_last"))
    near = near.where("start <= end and end >= _first").withColumn("_from", F.greatest("start", "_first"))
    covered = near.select(
        "service", "start", "end", *_NAMES, F.explode(F.sequence(bucket("_from"), bucket("end"))).alias("bucket")
    ).withColumns({"floor": F.col("bucket") * F.lit(bucket_micros), "part": F.lit(-1).cast("bigint")})
    # Events without a service find nothing, so they may lie anywhere.
    apart = F.when(F.col("service").isNull(), -2 - F.pmod(F.xxhash64("at"), F.lit(2**LEVELS)))
    rows = events.select(
        "service",
        bucket("at").alias("bucket"),
        F.coalesce(apart, F.lit(-1)).cast("bigint").alias("part"),
        "at",
        F.lit(0).cast("bigint").alias("step"),
        F.lit(1).alias("_kind"),
        F.struct("*").alias("_row"),
    )
    both = events.select("service", bucket("at").alias("bucket")).unionByName(covered.select("service", "bucket"))
    sizes = both.groupBy("service", "bucket").agg(F.count(F.lit(1)).alias("_size"))
    folder = work_folder(spark, "hot-buckets")
    sizes.where((F.col("_size") > hot_rows) & F.col("service").isNotNull() & F.col("bucket").isNotNull()).write.parquet(folder)
    # At most one row for each ``hot_rows`` rows; the planner broadcasts them if their files are small.
    hot = spark.read.schema("service string, bucket bigint, _size bigint").parquet(folder)
    if hot.isEmpty():
        remove_folder(spark, folder)
    else:
        covered, rows = _divide(covered, rows, hot, bucket_micros)

    place = ["service", "bucket", "part"]
    swept = covered.repartition(*place).sortWithinPartitions(*place, "start", "span_id")
    changes = swept.mapInPandas(_innermost, _CHANGES)
    # A change to "no span open" is a struct with null members, so it ends what was open before.
    marks = changes.select(
        *place, "at", "step", F.lit(0).alias("_kind"), F.struct(*_NAMES).alias("_found"), F.lit(None).alias("_row")
    )
    upto = Window.partitionBy(*place).orderBy("at", "_kind", "step")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    seen = marks.unionByName(rows.withColumn("_found", F.lit(None)))
    filled = seen.withColumn("_found", F.last("_found", ignorenulls=True).over(upto)).where(F.col("_kind") == 1)
    filled = filled.select("_row.*", "_found")
    return filled.withColumns({n: F.coalesce(present(n), F.col(f"_found.{n}")) for n in _NAMES}).drop("_found")


def resolve_trace(events: DataFrame, spans: DataFrame, runs: DataFrame, requests: DataFrame) -> DataFrame:
    """Trace and span of an event, each from the first that has one: event, active span, agent run, request header.

    Takes what :func:`active_spans`, :func:`attach_runs` and :func:`attach_requests` take, and adds what they add.
    """
    rows = attach_requests(attach_runs(active_spans(events, spans), runs), requests)
    return rows.withColumns({n: first_present(n, f"trace.{n}") for n in ("trace_id", "span_id")})


def session_metadata(**members: Column) -> Column:
    """JSON object text of string columns, for ``session_metadata``; null members are left out."""
    return object_of(*[(name, quote(value)) for name, value in members.items()])
