"""From audit events to sealed ledger rows: identities, guards, clocks, indexes, payloads, claim checks, accounting."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.functions import metadata as meta
from vaultrail.functions.crypto import Keyring, blind_index, seal, sealed_length, sha256_hex
from vaultrail.functions.jsontext import splice
from vaultrail.functions.numbers import floor_div
from vaultrail.functions.requests import PRESETS, apply_policy, event_policy
from vaultrail.functions.text import IDENTITY_LIMIT, TEXT_LIMIT, first_present, present, truncate, utf16_length
from vaultrail.operators.ordered import logical_clock, number_rows

# Ingestion limits and defaults.
UNKNOWN = "unknown"
CLAIM_CHECK_CHARS = 30720
BATCH_CAP = 100

AUDIT_EVENT = {
    "event_id": "bigint",
    "created_at": "timestamp",
    "actor": "string",
    "actor_id": "string",
    "actor_ref": "struct<id:string,pii:string>",
    "action": "string",
    "target": "string",
    "target_id": "string",
    "target_ref": "struct<id:string,pii:string>",
    "tenant": "string",
    "tenant_id": "string",
    "tenant_ref": "struct<id:string,pii:string>",
    "trace_id": "string",
    "span_id": "string",
    "parent_span_id": "string",
    "metadata": "string",
    "context": (
        "struct<ip:string,userAgent:string,location:struct<country:string,region:string,city:string>,"
        "device:struct<browser:string,os:string,type:string>>"
    ),
    "telemetry": "struct<preset:string,ip:string,user_agent:string,location:boolean>",
    "rationale": "string",
    "tool_name": "string",
    "logical_clock": "bigint",
    "attestation": (
        "struct<challenge:string,signature:string,authenticatorData:string,clientDataJSON:string,credentialId:string>"
    ),
    "request_id": "string",
    "max_meta": "bigint",
}


@dataclass(frozen=True)
class IngestPolicy:
    """What a ledger's owner sets once.

    ``redact`` and ``reference`` name ``actor``, ``target``, ``tenant`` or ``metadata.<key>``.
    """

    redact: tuple[str, ...] = field(default=())
    reference: tuple[str, ...] = field(default=())
    strings_only: bool = False
    max_metadata: int = meta.DEFAULT_LIMIT_CHARS
    telemetry: tuple[str, str, bool] = PRESETS["standard"]
    ingest_agent: tuple[str, str] | None = None

    @property
    def metadata_rules(self) -> meta.MetadataRules:
        return meta.MetadataRules(self.redact, self.reference, self.strings_only)


def with_event_columns(events: DataFrame) -> DataFrame:
    """Add the audit event columns an input does not have, as nulls."""
    missing = {n: F.lit(None).cast(t) for n, t in AUDIT_EVENT.items() if n not in events.columns}
    return events.withColumns(missing) if missing else events


# --- identities ------------------------------------------------------------------------------------------------------


def identity(name: str, part: str, default: str | None = UNKNOWN) -> Column:
    """Personal value (``part="pii"``) or stored id (``part="id"``) of actor, target or tenant.

    A reference struct comes first, then the plain value, then its id alias; empty text counts as missing.
    """
    plain = first_present(name, f"{name}_id")
    found = F.when(F.col(f"{name}_ref").isNotNull(), F.col(f"{name}_ref")[part]).otherwise(plain)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def indexed_identity(name: str, default: str | None = UNKNOWN) -> Column:
    """What the blind index of an identity is taken over."""
    return truncate(identity(name, "pii", default), IDENTITY_LIMIT)


def stored_identity(name: str, policy: IngestPolicy, default: str | None = UNKNOWN) -> Column:
    """What of an identity goes into the payload; a reference wins over a redaction."""
    value = identity(name, "pii", default)
    if name in policy.reference:
        return F.when(value.isNotNull(), F.concat(F.lit("[REF:"), identity(name, "id", default), F.lit("]")))
    if name in policy.redact:
        return F.when(value.isNotNull(), F.lit(f"[REDACTED:{name}]"))
    return value


# --- guards ----------------------------------------------------------------------------------------------------------


def guard_events(events: DataFrame, policy: IngestPolicy = IngestPolicy(), metadata_type=None) -> DataFrame:
    """Apply the metadata rules and set ``reject_reason`` on rows that may not enter the ledger.

    With ``metadata_type`` the ``metadata`` column is a struct of that type and no Python runs.
    """
    rules = policy.metadata_rules
    if metadata_type is not None:
        guarded = meta.guard_struct("metadata", metadata_type, rules)
    else:
        guarded = meta.guard(F.col("metadata"), rules)
    limit = F.coalesce(F.nullif(F.col("max_meta"), F.lit(0)), F.lit(policy.max_metadata))
    return (
        events.withColumn("_guarded", guarded)
        .withColumns(
            {
                "metadata": F.col("_guarded.metadata"),
                "truncated_depth": F.col("_guarded.truncated_depth"),
                "truncated_string": F.col("_guarded.truncated_string"),
                "reject_reason": F.when(F.col("action").isNull(), "action_missing")
                .when(F.col("_guarded.invalid"), "metadata_invalid")
                .when(F.col("_guarded.oversize"), "metadata_over_hard_limit")
                .when(utf16_length("_guarded.metadata") > limit, "metadata_over_limit"),
            }
        )
        .drop("_guarded")
    )


# --- envelopes -------------------------------------------------------------------------------------------------------


def payload_text(policy: IngestPolicy, context: Column) -> Column:
    """Payload JSON in its fixed field order; absent fields are left out and the metadata text is kept to the byte."""
    head = F.to_json(
        F.struct(
            stored_identity("actor", policy).alias("actor"),
            truncate("action", IDENTITY_LIMIT).alias("action"),
            stored_identity("target", policy).alias("target"),
        )
    )
    tail = F.to_json(
        F.struct(
            present(stored_identity("tenant", policy, None)).alias("tenant"),
            context.alias("context"),
            present("span_id").alias("spanId"),
            present("parent_span_id").alias("parentSpanId"),
        )
    )
    body = F.concat(F.lit('{"metadata":'), F.col("metadata"), F.lit("}"))
    return splice(head, body, tail)


def event_context(policy: IngestPolicy, key: Column) -> Column:
    """Stored context of an event; see :func:`apply_policy`."""
    ip, user_agent, location = policy.telemetry
    base = F.struct(F.lit(ip).alias("ip"), F.lit(user_agent).alias("user_agent"), F.lit(location).alias("location"))
    own = F.col("telemetry")
    chosen = event_policy(base, own["preset"], own["ip"], own["user_agent"], own["location"])
    full = F.when(own.isNotNull(), F.coalesce(own["preset"] == "full", F.lit(False))).otherwise(F.lit(ip == "track"))
    return apply_policy(F.col("context"), chosen, key, full, policy.ingest_agent)


def seal_events(events: DataFrame, keyring: Keyring, policy: IngestPolicy = IngestPolicy()) -> DataFrame:
    """Envelope columns of guarded events.

    ``payload`` is the sealed text itself; :func:`accepted_rows` and :func:`claim_blobs` move large ones behind a claim check. Which rows are
    large is known by arithmetic before anything is sealed.
    """
    key = F.col("_key")
    ready = keyring.attach(events).withColumn("_context", event_context(policy, key))
    ready = ready.withColumn("_payload", payload_text(policy, F.col("_context")))
    tenant, trace = present(indexed_identity("tenant", None)), present("trace_id")
    agent = F.to_json(
        F.struct(
            F.substring(present("rationale"), 1, TEXT_LIMIT).alias("rationale"), present("tool_name").alias("toolName")
        )
    )
    agent_id = F.concat(F.lit("agent:"), F.col("event_id").cast("string"))
    return ready.withColumns(
        {
            "actor_index": blind_index(indexed_identity("actor"), key),
            "action_index": blind_index(truncate("action", IDENTITY_LIMIT), key),
            "target_index": blind_index(indexed_identity("target"), key),
            "tenant_index": blind_index(tenant, key),
            "trace_index": blind_index(trace, key),
            "is_claim_check": sealed_length(F.col("_payload"), key) > CLAIM_CHECK_CHARS,
            "payload": seal(F.col("_payload"), F.col("event_id"), key),
            "agent_context": F.when(agent != "{}", seal(agent, agent_id, key)),
            "attestation_proof": F.to_json("attestation"),
        }
    ).drop("_payload", "_context", "_key")


ENVELOPE = [
    "event_id",
    "created_at",
    "actor_index",
    "action_index",
    "target_index",
    "tenant_index",
    "trace_index",
    "payload",
    "logical_clock",
    "is_claim_check",
    "agent_context",
    "attestation_proof",
]


def assign_clocks(events: DataFrame, chunk: list[Column], base: Column | None = None) -> DataFrame:
    """Logical clocks per request in event order; rejected rows do not tick.

    An explicit ``logical_clock`` on an event is taken as the incoming clock. Events outside any request share one
    clock, which starts at 0.
    """
    outside = F.col("request_id").isNull()
    own = F.coalesce(F.col("request_id").cast("string"), F.lit(""))
    marked = events.withColumns({"_ticks": F.col("reject_reason").isNull(), "_outside": outside, "_scope": own})
    start = F.lit(0) if base is None else F.when(F.col("_outside"), F.lit(0)).otherwise(base)
    clocked = logical_clock(marked, ["_scope", "_outside", "_ticks"], ["event_id"], chunk, F.col("logical_clock"), start)
    ticked = clocked.withColumn("logical_clock", F.when(F.col("_ticks"), F.col("logical_clock")))
    return ticked.drop("_ticks", "_outside", "_scope")


def staged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Staged rows with their place in the stage, which tells rows of one ``event_id`` apart."""
    return spark.read.parquet(folder).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


#: Sealed columns, which are most of a row's bytes and which clocks do not need.
SEALED = ["actor_index", "action_index", "target_index", "tenant_index", "trace_index", "payload", "agent_context", "attestation_proof"]


def with_clocks(staged: DataFrame, clocks: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Staged rows with the ``logical_clock`` that ``clocks`` gives them, a function of rows without their sealed columns.

    The steps of the clocks move narrow rows only; sealed texts and indexes move once, to meet their clock.
    """
    clocked = clocks(staged.drop(*SEALED)).select("_file", "_row", "logical_clock")
    # Indexes are hexadecimal and move as half as many bytes.
    indexes = [c for c in SEALED if c.endswith("_index")]
    packed = staged.drop("logical_clock").withColumns({c: F.unhex(c) for c in indexes})
    return packed.join(clocked, ["_file", "_row"]).withColumns({c: F.lower(F.hex(c)) for c in indexes})


def accepted_rows(sealed: DataFrame) -> DataFrame:
    """Ledger rows; a claim-checked row holds the hash of its sealed text."""
    return (
        sealed.where(F.col("reject_reason").isNull())
        .withColumn("payload", F.when(F.col("is_claim_check"), sha256_hex("payload")).otherwise(F.col("payload")))
        .select(*ENVELOPE)
    )


def claim_blobs(sealed: DataFrame) -> DataFrame:
    """Content-addressed sealed texts of claim-checked rows."""
    large = sealed.where(F.col("reject_reason").isNull() & F.col("is_claim_check"))
    return large.select(sha256_hex("payload").alias("hash"), F.col("payload").alias("blob")).dropDuplicates(["hash"])


def put_blobs(blobs: DataFrame, put: Callable[[str, str], bool | None]) -> DataFrame:
    """Store blobs ``(hash, blob)`` by a caller's function inside the tasks; returns ``(hash, stored)``.

    A blob counts as stored unless ``put(hash, blob)`` raises or returns False. A repeated task calls it again.
    """

    def run(frames):
        for frame in frames:
            stored = []
            for name, text in zip(frame["hash"], frame["blob"], strict=True):
                try:
                    stored.append(put(name, text) is not False)
                except Exception:  # noqa: BLE001 - whatever the store raises, the text is kept in its row
                    stored.append(False)
            yield frame[["hash"]].assign(stored=stored)

    return blobs.mapInPandas(run, "hash string, stored boolean")


def keep_inline(sealed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Sealed events with the claim check taken off those whose blob ``(hash, stored)`` could not be stored.

    Only claim-checked rows meet the outcomes; the others pass by without a shuffle.
    """
    large = F.coalesce(F.col("is_claim_check"), F.lit(False))
    missed = outcomes.where("not stored").select(F.col("hash").alias("_hash"), F.lit(True).alias("_missed")).dropDuplicates(["_hash"])
    met = sealed.where(large).join(missed, sha256_hex("payload") == F.col("_hash"), "left")
    met = met.withColumn("is_claim_check", F.col("_missed").isNull()).drop("_hash", "_missed")
    return sealed.where(~large).unionByName(met)


def reseal(opened: DataFrame, keyring: Keyring) -> DataFrame:
    """Seal opened ledger rows again under the active key, the last step of a key rotation.

    Takes rows of :func:`vaultrail.operators.search.open_ledger` with claims resolved. A row that could not be opened
    keeps its sealed text. Claim checks are decided anew, since the hash of a sealed text changes with its key; split
    the result with :func:`accepted_rows` and :func:`claim_blobs`.
    """
    key = F.col("_key")
    agent_id = F.concat(F.lit("agent:"), F.col("event_id").cast("string"))
    renewed = {
        "payload": F.coalesce(seal(F.col("opened"), F.col("event_id"), key), "payload"),
        "agent_context": F.coalesce(seal(F.col("agent"), agent_id, key), "agent_context"),
    }
    large = {"is_claim_check": F.length("payload") > CLAIM_CHECK_CHARS, "reject_reason": F.lit(None).cast("string")}
    return keyring.attach(opened).withColumns(renewed).withColumns(large).drop("_key", "opened", "agent")


def rejected_rows(sealed: DataFrame) -> DataFrame:
    return sealed.where(F.col("reject_reason").isNotNull())


# --- batches ---------------------------------------------------------------------------------------------------------


def cap_batches(
    events: DataFrame, position: str | None = None, batch: str = "batch_id", order: str = "event_id", chunk=None
) -> DataFrame:
    """Mark rows past the cap of their request batch as rejected.

    ``position`` is the row's 1-based place in its batch if the input knows it; otherwise it is numbered along
    ``order`` with the given chunks.
    """
    if position is None:
        position = "position"
        events = number_rows(events, [batch], [order], chunk, position)
    over = F.col(position) > BATCH_CAP
    reason = F.col("reject_reason") if "reject_reason" in events.columns else F.lit(None).cast("string")
    return events.withColumn("reject_reason", F.when(over, "over_batch_cap").otherwise(reason))


def batch_counts(events: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Accepted and rejected rows per batch."""
    bad = F.col("reject_reason").isNotNull()
    return events.groupBy(batch).agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))


def flush_groups(events: DataFrame, position: str = "position", size: int = BATCH_CAP) -> DataFrame:
    """Number of the flush a buffered row leaves with; flushes hold at most the batch cap."""
    step = min(size or BATCH_CAP, BATCH_CAP)
    return events.withColumn("flush", floor_div(F.col(position) - 1, step))


def dead_letters(rejected: DataFrame, payload: Column, error: Column, at: Column) -> DataFrame:
    """One dead letter per rejected row: UTC day, ISO time, error and payload."""
    return rejected.select(
        F.to_date(at).alias("dt"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        error.alias("error"),
        payload.alias("payload"),
    )
