"""Trace spans and log records as audit events, and audit events as span events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultrail.functions.jsontext import quote, splice
from vaultrail.functions.text import first_present
from vaultrail.session import materialise

# Attribute prefix of explicit audit events, unless the caller has an own one; "audit" is the generic second choice.
PREFIX = "vaultrail"
GENERIC = "audit"

EVENT_COLUMNS = [
    "source",
    "action",
    "actor",
    "actor_ref",
    "target",
    "target_ref",
    "tenant",
    "tenant_ref",
    "trace_id",
    "span_id",
    "parent_span_id",
    "rationale",
    "tool_name",
    "logical_clock",
    "metadata",
]


PAYLOAD_SCHEMA = (
    "action string, actor variant, actorId string, target variant, targetId string, tenant variant, tenantId string, "
    "traceId string, spanId string, parentSpanId string, rationale string, toolName string, logicalClock string, "
    "metadata string, _corrupt string"
)


def read_payload(text: Column) -> Column:
    """Payload JSON as one struct, parsed once; see :func:`is_payload` for texts that are none."""
    return F.from_json(text, PAYLOAD_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"})


def is_payload(text: Column, payload: Column) -> Column:
    """Whether a text is a JSON object."""
    return F.coalesce(payload["_corrupt"].isNull() & F.startswith(F.ltrim(text), F.lit("{")), F.lit(False))


def payload_columns(payload: Column) -> dict[str, Column]:
    """Audit event columns of a parsed payload; the metadata is kept as JSON text."""

    def inside(name: str, path: str) -> Column:
        return F.try_variant_get(payload[name], path, "string")

    def reference(name: str) -> Column:
        identity, personal = inside(name, "$.id"), inside(name, "$.pii")
        found = identity.isNotNull() | personal.isNotNull()
        return F.when(found, F.struct(identity.alias("id"), personal.alias("pii")))

    def plain(name: str) -> Column:
        value = F.when(~F.startswith(F.schema_of_variant(payload[name]), F.lit("OBJECT")), inside(name, "$"))
        return F.when(reference(name).isNull(), first_present(value, payload[f"{name}Id"]))

    return {
        "source": F.lit("explicit"),
        "action": payload["action"],
        "actor": plain("actor"),
        "actor_ref": reference("actor"),
        "target": plain("target"),
        "target_ref": reference("target"),
        "tenant": plain("tenant"),
        "tenant_ref": reference("tenant"),
        "trace_id": payload["traceId"],
        "span_id": payload["spanId"],
        "parent_span_id": payload["parentSpanId"],
        "rationale": payload["rationale"],
        "tool_name": payload["toolName"],
        "logical_clock": payload["logicalClock"].try_cast("bigint"),
        "metadata": F.coalesce(payload["metadata"], F.lit("{}")),
    }


def _attribute(attributes: Column, name: str, prefix: str) -> Column:
    return first_present(attributes[f"{prefix}.{name}"], attributes[f"{GENERIC}.{name}"])


def generic_columns(attributes: Column, prefix: str, trace: Column, span: Column, parent: Column, metadata: Column) -> dict[str, Column]:
    """Audit event columns of annotated attributes."""
    none = F.lit(None)
    reference = none.cast("struct<id:string,pii:string>")
    return {
        "source": F.lit("generic"),
        "action": _attribute(attributes, "action", prefix),
        "actor": F.coalesce(_attribute(attributes, "actor", prefix), F.lit("unknown")),
        "actor_ref": reference,
        "target": _attribute(attributes, "target", prefix),
        "target_ref": reference,
        "tenant": _attribute(attributes, "tenant", prefix),
        "tenant_ref": reference,
        "trace_id": trace,
        "span_id": span,
        "parent_span_id": parent,
        "rationale": none.cast("string"),
        "tool_name": none.cast("string"),
        "logical_clock": none.cast("bigint"),
        "metadata": metadata,
    }


def explode_span_events(spans: DataFrame) -> DataFrame:
    """Span events as rows, for spans that carry them as an array."""
    return spans.select("trace_id", "span_id", F.explode("events").alias("e")).select(
        "trace_id", "span_id", F.col("e.name").alias("name"), F.col("e.attributes").alias("attributes")
    )


def span_audit_events(spans: DataFrame, span_events: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Audit events of spans: all readable explicit events of a span, or else its annotated attributes.

    ``spans(trace_id, span_id, parent_span_id, attributes)`` and ``span_events(trace_id, span_id, name, attributes)``.
    Explicit events are parsed once and stored in the shared folder, since they are both the result and what other spans are held against.
    """
    text = F.col("attributes")[f"{prefix}.payload"]
    named = span_events.where((F.col("name") == f"{prefix}.audit") & text.isNotNull())
    parsed = named.select("trace_id", "span_id", text.alias("_text"), read_payload(text).alias("_payload"))
    payload = F.col("_payload")
    # Exploding one or no event instead of filtering: a filter would be pushed down with its own copy of the parsing.
    event = F.struct(*[c.alias(n) for n, c in payload_columns(payload).items()])
    one = F.explode(F.when(is_payload(F.col("_text"), payload), F.array(event))).alias("e")
    explicit = materialise(parsed.select("trace_id", "span_id", one), "span-explicit")
    own = explicit.select("e.*")
    redirected = explicit.select("trace_id", "span_id").dropDuplicates()
    annotated = spans.where(_attribute(F.col("attributes"), "action", prefix).isNotNull()).join(
        redirected, ["trace_id", "span_id"], "left_anti"
    )
    attributes = F.col("attributes")
    mapped = generic_columns(
        attributes, prefix, F.col("trace_id"), F.col("span_id"), F.col("parent_span_id"), F.to_json(attributes)
    )
    return own.unionByName(annotated.select(*[c.alias(n) for n, c in mapped.items()]))


def log_audit_events(logs: DataFrame, prefix: str = PREFIX, keep: list[str] | None = None) -> DataFrame:
    """Audit events of log records ``(trace_id, span_id, body, attributes)``, each record by the same rule.

    The decision is made inside the row, so nothing is shuffled. ``keep`` names input columns to pass through.
    """
    attributes = F.col("attributes")
    text = attributes[f"{prefix}.payload"]
    body = F.when(F.col("body").isNotNull(), F.concat(F.lit('{"body":'), quote("body"), F.lit("}")))
    metadata = splice(F.to_json(attributes), body)
    none = F.lit(None).cast("string")
    mapped = generic_columns(attributes, prefix, F.col("trace_id"), F.col("span_id"), none, metadata)
    parsed = payload_columns(F.col("_payload"))
    chosen = [F.when(F.col("_explicit"), parsed[n]).otherwise(mapped[n]).alias(n) for n in EVENT_COLUMNS]
    usable = F.col("_explicit") | _attribute(attributes, "action", prefix).isNotNull()
    read = logs.withColumn("_payload", read_payload(text))
    marked = read.withColumn("_explicit", text.isNotNull() & is_payload(text, F.col("_payload")))
    return marked.where(usable).select(*(keep or []), *chosen)


def redirect_to_spans(events: DataFrame, spans: DataFrame, payload: Column, prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """Events with a known span become span events that hold the payload; the others go to the ledger directly.

    Span events stay one row each, so a span with very many of them is no single value.
    """
    known = spans.select("trace_id", "span_id").dropDuplicates().withColumn("_span", F.lit(True))
    joined = events.join(known, ["trace_id", "span_id"], "left")
    attached = joined.where(F.col("_span").isNotNull()).select(
        "event_id",
        "trace_id",
        "span_id",
        F.lit(f"{prefix}.audit").alias("name"),
        F.create_map(F.lit(f"{prefix}.payload"), payload).alias("attributes"),
    )
    return attached, joined.where(F.col("_span").isNull()).drop("_span")
