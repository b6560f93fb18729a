"""Sealing, search and ingestion queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultrail.functions.crypto import Keyring, blind_index, blind_indexes, seal, sealed_key_id
from vaultrail.functions.jsontext import object_of, quote
from vaultrail.functions.metadata import MetadataRules, guard, guard_struct
from vaultrail.functions.text import TEXT_LIMIT, present
from vaultrail.operators import ingest, search
from vaultrail.operators.ordered import int_chunk
from vaultrail.plans import inputs
from vaultrail.plans.inputs import KEYRING
from vaultrail.plans.oracle import AUDIT, IDENTITIES, PAYLOAD, hmac, sealed_length, with_
from vaultrail.plans.registry import registrar
from vaultrail.session import materialise, work_folder
from vaultrail.sources import ledger as store

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)


def audit(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.with_event_columns(inputs.audit(spark, folder))


METADATA_K = T.StructType([T.StructField("k", T.LongType())])


def guarded_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audit events through the guards; their metadata has a known type, so no Python is involved."""
    events = audit(spark, folder).withColumn("metadata", F.from_json("metadata", METADATA_K))
    return ingest.guard_events(events, metadata_type=METADATA_K)


def sealed_audit(spark: SparkSession, folder: str, keyring: Keyring = KEYRING) -> DataFrame:
    clocked = ingest.assign_clocks(guarded_audit(spark, folder), [int_chunk("event_id")])
    return ingest.seal_events(clocked, keyring)


SEARCHED = ["usr_7", "usr_42"]


@query(
    with_(AUDIT, IDENTITIES)
    + "SELECT action, count(*) AS n FROM ids WHERE who IN ('usr_7', 'usr_42') GROUP BY action"
)
def blind_index_search(spark, folder):
    """Events of two actors, found by index although the signups were written under an older key."""
    events = audit(spark, folder)
    keyed = KEYRING.attach(Keyring(KEYRING.keys, "v1").attach(events, "_old"))
    key = F.when(F.col("action") == "event.signup", F.col("_old")).otherwise(F.col("_key"))
    ledger = keyed.select("action", blind_index(ingest.indexed_identity("actor"), key).alias("actor_index"))
    return search.search_literals(ledger, KEYRING, "actor_index", SEARCHED).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(
    with_(AUDIT, IDENTITIES)
    + f"""SELECT event_id, {hmac('who')} AS actor_index, {hmac('action')} AS action_index, {hmac('target')} AS target_index,
      {hmac('tenant')} AS tenant_index, CASE WHEN trace_id IS NOT NULL THEN {hmac("trace_id")} END AS trace_index FROM ids"""
)
def blind_index_columns(spark, folder):
    key = F.col("_key")
    return KEYRING.attach(audit(spark, folder)).select(
        "event_id",
        blind_index(ingest.indexed_identity("actor"), key).alias("actor_index"),
        blind_index("action", key).alias("action_index"),
        blind_index(ingest.indexed_identity("target"), key).alias("target_index"),
        blind_index(present(ingest.indexed_identity("tenant", None)), key).alias("tenant_index"),
        blind_index(present("trace_id"), key).alias("trace_index"),
    )


@query(
    with_(AUDIT)
    + f"""SELECT tenant, list_extract(t, 1) AS index_v1, list_extract(t, 2) AS index_v2 FROM (
      SELECT tenant, [{hmac('tenant', 'v1')}, {hmac('tenant', 'v2')}] AS t FROM (SELECT DISTINCT tenant FROM audit))"""
)
def keyring_indexes(spark, folder):
    """One index per key for every tenant."""
    tenants = audit(spark, folder).select("tenant").dropDuplicates()
    tokens = KEYRING.attach_all(tenants).withColumn("tokens", blind_indexes("tenant", F.col("_keys")))
    return tokens.select("tenant", F.col("tokens")[0].alias("index_v1"), F.col("tokens")[1].alias("index_v2"))


@query(
    with_(AUDIT)
    + """SELECT event_id, COALESCE(actor, actor_id, 'unknown') AS actor, target, tenant FROM audit"""
)
def alias_resolution(spark, folder):
    return audit(spark, folder).select(
        "event_id",
        ingest.identity("actor", "pii").alias("actor"),
        ingest.identity("target", "pii").alias("target"),
        ingest.identity("tenant", "pii", None).alias("tenant"),
    )


@query(
    """SELECT doc_id, CASE WHEN length(text) > 255 THEN substr(text, 1, 255) || '...' ELSE text END AS indexed,
      sha256(text) AS stored_hash FROM documents"""
)
def identity_truncation(spark, folder):
    """The index sees at most 255 characters of an identity, the payload all of it."""
    docs = inputs.table(spark, folder, "documents").withColumn("actor", F.col("text"))
    docs = ingest.with_event_columns(docs)
    return docs.select(
        "doc_id",
        ingest.indexed_identity("actor").alias("indexed"),
        F.sha2(ingest.stored_identity("actor", ingest.IngestPolicy()), 256).alias("stored_hash"),
    )


@query(
    with_(AUDIT, IDENTITIES)
    + f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '[REF:id_' || user_id || ']' ELSE '[REF:' || who || ']' END AS actor,
      '[REDACTED:target]' AS target, tenant,
      CASE WHEN event_id % 2 = 0 THEN {hmac("'mail_' || user_id || '@example.com'")} ELSE {hmac('who')} END AS actor_index FROM ids"""
)
def redact_reference(spark, folder):
    """References win over redactions and the index is still taken from the personal value."""
    policy = ingest.IngestPolicy(redact=("actor", "target"), reference=("actor",))
    user = F.col("user_id")
    ref = F.struct(inputs.text("id_", user).alias("id"), inputs.text("mail_", user, "@example.com").alias("pii"))
    events = audit(spark, folder).withColumn("actor_ref", F.when(F.col("event_id") % 2 == 0, ref))
    return KEYRING.attach(events).select(
        "event_id",
        ingest.stored_identity("actor", policy).alias("actor"),
        ingest.stored_identity("target", policy).alias("target"),
        ingest.stored_identity("tenant", policy, None).alias("tenant"),
        blind_index(ingest.indexed_identity("actor"), F.col("_key")).alias("actor_index"),
    )


DOC_RULES = MetadataRules(redact=("metadata.email",), reference=("metadata.owner",))


@query(
    """SELECT doc_id, CASE WHEN length(text) > 1000 THEN substr(text, 1, 1000) || '...' ELSE text END AS body,
      '[REDACTED:email]' AS email, '[REF:o_' || doc_id || ']' AS owner,
      '{"a":{"b":{"c":{"d":"[Truncated - Depth Exceeded]"}}}}' AS deep, '1.5' AS amount, true AS truncated_depth,
      length(text) > 1000 AS truncated_string FROM documents"""
)
def metadata_guard(spark, folder):
    """Redaction, references, depth and string limits on free JSON text."""
    docs = inputs.table(spark, folder, "documents")
    d = F.col("doc_id")
    metadata = object_of(
        ("body", quote("text")),
        ("email", F.lit('"x@example.com"')),
        ("owner", inputs.text('{"id":"o_', d, '", "pii":"p"}')),
        ("deep", inputs.text('{"a": {"b": {"c": {"d": ', d, "}}}}")),
        ("amount", F.lit("1.50")),
    )
    part = lambda name: F.get_json_object("g.metadata", f"$.{name}").alias(name)
    return docs.select("doc_id", guard(metadata, DOC_RULES).alias("g")).select(
        "doc_id", part("body"), part("email"), part("owner"), part("deep"), part("amount"), "g.truncated_depth", "g.truncated_string"
    )


@query(
    """SELECT doc_id, CASE WHEN length(text) > 1000 THEN substr(text, 1, 1000) || '...' ELSE text END AS body,
      '[REDACTED:email]' AS email, '[REF:o_' || doc_id || ']' AS owner,
      '{"a":{"b":{"c":{"d":"[Truncated - Depth Exceeded]"}}}}' AS deep, to_json([lang, source])::VARCHAR AS tags,
      true AS truncated_depth, length(text) > 1000 AS truncated_string FROM documents"""
)
def metadata_guard_typed(spark, folder):
    """The same rules as expressions, for metadata of a known type."""
    docs = inputs.table(spark, folder, "documents")
    d = F.col("doc_id")
    deep = F.struct(F.struct(F.struct(F.struct(d.alias("d")).alias("c")).alias("b")).alias("a"))
    typed = F.struct(
        F.col("text").alias("body"),
        F.lit("x@example.com").alias("email"),
        F.struct(inputs.text("o_", d).alias("id"), F.lit("p").alias("pii")).alias("owner"),
        deep.alias("deep"),
        F.array("lang", "source").alias("tags"),
    )
    docs = docs.select("doc_id", typed.alias("m"))
    kind = docs.schema["m"].dataType
    guarded = docs.select("doc_id", guard_struct("m", kind, DOC_RULES).alias("g"))
    part = lambda name: F.get_json_object("g.metadata", f"$.{name}").alias(name)
    return guarded.select(
        "doc_id", part("body"), part("email"), part("owner"), part("deep"), part("tags"), "g.truncated_depth", "g.truncated_string"
    )


def document_events(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as events; their whole text is the metadata, in pieces no string limit cuts."""
    docs = inputs.table(spark, folder, "documents")
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / F.lit(TEXT_LIMIT)).cast("int"))
    pieces = F.transform(starts, lambda i: F.substring(F.col("text"), i * TEXT_LIMIT + 1, F.lit(TEXT_LIMIT)))
    return ingest.with_event_columns(
        docs.select(
            F.col("doc_id").alias("event_id"),
            F.lit("doc.stored").alias("action"),
            F.col("source").alias("actor"),
            F.col("lang").alias("tenant"),
            F.to_json(F.struct(F.when(F.length("text") > 0, pieces).otherwise(F.array().cast("array<string>")).alias("parts"))).alias("metadata"),
        )
    )


DOC_META = """docs AS (SELECT doc_id, source, lang, text,
    '{"parts":' || to_json(list_transform(range(0, CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - 1) // 1000 + 1 END),
      lambda i: substr(text, i * 1000 + 1, 1000)))::VARCHAR || '}' AS metadata FROM documents)"""

DOC_PAYLOAD = (
    """'{"actor":"' || source || '","action":"doc.stored","target":"unknown","metadata":' || metadata """
    """|| ',"tenant":"' || lang || '","context":{"location":{}}}'"""
)


@query(
    with_(DOC_META)
    + """SELECT doc_id, length(metadata) AS metadata_chars, CASE WHEN length(metadata) > 10240 THEN 'metadata_over_limit' END AS reject_reason
      FROM docs"""
)
def size_guard_reject(spark, folder):
    guarded = ingest.guard_events(document_events(spark, folder))
    return guarded.select(
        F.col("event_id").alias("doc_id"), F.length("metadata").cast("bigint").alias("metadata_chars"), "reject_reason"
    )


LARGE = ingest.IngestPolicy(max_metadata=5_242_880)


def sealed_documents(spark: SparkSession, folder: str, keyring: Keyring = KEYRING) -> DataFrame:
    events = ingest.guard_events(document_events(spark, folder), LARGE)
    return ingest.seal_events(events, keyring, LARGE)


@query(
    with_(DOC_META)
    + f"""SELECT doc_id, {sealed_length(DOC_PAYLOAD)} > 30720 AS is_claim_check,
      CASE WHEN {sealed_length(DOC_PAYLOAD)} > 30720 THEN 64 ELSE {sealed_length(DOC_PAYLOAD)} END AS payload_chars FROM docs"""
)
def claim_check_flags(spark, folder):
    rows = ingest.accepted_rows(sealed_documents(spark, folder))
    return rows.select(
        F.col("event_id").alias("doc_id"), "is_claim_check", F.length("payload").cast("bigint").alias("payload_chars")
    )


@query(with_(DOC_META) + f"SELECT doc_id, {DOC_PAYLOAD} AS opened FROM docs")
def claim_check_resolve(spark, folder):
    """Large texts go to the blob table and come back through the hash."""
    sealed = materialise(sealed_documents(spark, folder), "documents")
    resolved = search.resolve_claims(ingest.accepted_rows(sealed), ingest.claim_blobs(sealed))
    return search.open_ledger(resolved, KEYRING).select(F.col("event_id").alias("doc_id"), "opened")


@query(
    with_(AUDIT, IDENTITIES)
    + f"SELECT event_id, {PAYLOAD} AS opened, {sealed_length(PAYLOAD)} AS sealed_chars FROM ids"
)
def seal_roundtrip(spark, folder):
    """Seal every event and open it again."""
    opened = search.open_ledger(ingest.accepted_rows(sealed_audit(spark, folder)), KEYRING)
    return opened.select("event_id", "opened", F.length("payload").cast("bigint").alias("sealed_chars"))


@query(
    with_(AUDIT)
    + """SELECT event_id, rationale, tool_name FROM audit WHERE rationale IS NOT NULL OR tool_name IS NOT NULL"""
)
def agent_context_roundtrip(spark, folder):
    opened = search.open_ledger(ingest.accepted_rows(sealed_audit(spark, folder)), KEYRING)
    return opened.where(F.col("agent_context").isNotNull()).select(
        "event_id",
        F.get_json_object("agent", "$.rationale").alias("rationale"),
        F.get_json_object("agent", "$.toolName").alias("tool_name"),
    )


@query(
    with_(AUDIT)
    + """SELECT key_id, count(*) AS rows, count(*) AS readable FROM (
      SELECT CASE WHEN event_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS key_id FROM audit) GROUP BY key_id"""
)
def keyring_rotation_report(spark, folder):
    """Rows per key while a rotation is under way, and how many of them can be read."""
    events = audit(spark, folder)
    keyed = KEYRING.attach(Keyring(KEYRING.keys, "v1").attach(events, "_old"), "_new")
    keyed = keyed.withColumn("_key", F.when(F.col("event_id") % 2 == 0, F.col("_old")).otherwise(F.col("_new")))
    sealed = seal(F.col("metadata"), F.col("event_id"), F.col("_key"))
    rows = keyed.select(sealed.alias("payload"), F.lit(None).cast("string").alias("agent_context"), "metadata")
    opened = search.open_ledger(rows, KEYRING)
    return opened.groupBy(sealed_key_id("payload").alias("key_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("opened") == F.col("metadata")).alias("readable")
    )


def batched(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of 130 events; an event without an action is invalid."""
    events = audit(spark, folder).withColumn("action", F.when(F.col("event_id") % 101 != 0, F.col("action")))
    events = events.withColumn("reject_reason", F.when(F.col("action").isNull(), "action_missing"))
    return ingest.cap_batches(events, chunk=[int_chunk("event_id")])


@query(
    with_(AUDIT)
    + """SELECT batch_id, count(*) FILTER (n <= 100 AND event_id % 101 <> 0) AS accepted,
      count(*) FILTER (n > 100 OR event_id % 101 = 0) AS rejected
      FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY event_id) AS n FROM audit) GROUP BY batch_id"""
)
def batch_accounting(spark, folder):
    return ingest.batch_counts(batched(spark, folder))


@query(
    with_(AUDIT)
    + """SELECT batch_id, (n - 1) // 40 AS flush, count(*) AS rows, min(event_id) AS first_event
      FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY event_id) AS n FROM audit) GROUP BY ALL"""
)
def flush_groups(spark, folder):
    """Buffered rows by the flush they leave with, at most forty at a time."""
    placed = ingest.number_rows(audit(spark, folder), ["batch_id"], ["event_id"], [int_chunk("event_id")])
    return ingest.flush_groups(placed, size=40).groupBy("batch_id", "flush").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_event")
    )


@query(
    with_(AUDIT)
    + """SELECT strftime(created_at, '%Y-%m-%d') AS dt, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp,
      CASE WHEN n > 100 THEN 'over_batch_cap' ELSE 'action_missing' END AS error,
      '{"event_id":' || event_id || ',"target":"' || target || '"}' AS payload
      FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY event_id) AS n FROM audit)
      WHERE n > 100 OR event_id % 101 = 0"""
)
def dead_letters(spark, folder):
    """Rejected rows written to daily files and read back."""
    rejected = ingest.rejected_rows(batched(spark, folder))
    payload = F.to_json(F.struct("event_id", "target"))
    letters = ingest.dead_letters(rejected, payload, F.col("reject_reason"), F.col("created_at"))
    path = work_folder(spark, "letters")
    store.write_dead_letters(letters, path)
    back = store.read_dead_letters(spark, path)
    return back.withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


@query(
    with_(AUDIT, IDENTITIES)
    + f"""SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS rows, count(DISTINCT {hmac('who')}) AS actors FROM ids GROUP BY 1"""
)
def ledger_append(spark, folder):
    """Guard, seal and append events to a stored ledger, and read it back by day."""
    path = work_folder(spark, "ledger")
    store.ingest_events(inputs.audit(spark, folder), path, KEYRING, [int_chunk("event_id")])
    rows = store.read_rows(spark, path)
    return rows.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("actor_index").alias("actors")
    )


CLOCKS = """n AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY event_id) AS pos,
      COALESCE(logical_clock, 0) - row_number() OVER (PARTITION BY request_id ORDER BY event_id) + 1 AS lift FROM ids),
  ledger AS (SELECT * EXCLUDE (logical_clock), pos + greatest(0, max(lift) OVER (PARTITION BY request_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)) AS logical_clock FROM n)"""


@query(
    with_(AUDIT, IDENTITIES, CLOCKS)
    + f"""SELECT event_id, {PAYLOAD} AS opened, logical_clock, rationale, tool_name FROM ledger WHERE who IN ('usr_7', 'usr_42')"""
)
def ledger_search(spark, folder):
    """Events ingested into a stored ledger, found there by the actor's index, with claims resolved and opened."""
    path = work_folder(spark, "ledger")
    store.ingest_events(inputs.audit(spark, folder), path, KEYRING, [int_chunk("event_id")])
    found = search.search_literals(store.read_rows(spark, path), KEYRING, "actor_index", SEARCHED)
    opened = search.open_ledger(search.resolve_claims(found, store.read_blobs(spark, path)), KEYRING)
    part = lambda name: F.get_json_object("agent", f"$.{name}")
    return opened.select("event_id", "opened", "logical_clock", part("rationale").alias("rationale"), part("toolName").alias("tool_name"))


@query(
    with_(AUDIT)
    + """SELECT event_id, actor, actor_id, action, target, tenant, trace_id, span_id, metadata, logical_clock, 'https' AS scheme FROM audit"""
)
def event_source(spark, folder):
    """Events written as JSON lines and read back with the event schema; what is missing is null."""
    path = work_folder(spark, "events")
    inputs.audit(spark, folder).withColumn("attestation", F.struct(F.lit("https").alias("challenge"))).write.json(path)
    back = store.read_events(spark, path, "json")
    names = ["event_id", "actor", "actor_id", "action", "target", "tenant", "trace_id", "span_id", "metadata", "logical_clock"]
    return back.select(*names, F.col("attestation.challenge").alias("scheme"))


@query(
    with_(AUDIT)
    + """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{"challenge":"c' || event_id || '","signature":"s","authenticatorData":"a"'
        || CASE WHEN event_id % 2 = 0 THEN ',"clientDataJSON":"d"' ELSE '' END || ',"credentialId":"i"}' END AS attestation_proof FROM audit"""
)
def attestation_text(spark, folder):
    """Attestations are stored as JSON, in clear."""
    e = F.col("event_id")
    client = F.when(e % 2 == 0, "d").alias("clientDataJSON")
    given = F.struct(
        inputs.text("c", e).alias("challenge"), F.lit("s").alias("signature"), F.lit("a").alias("authenticatorData"), client, F.lit("i").alias("credentialId")
    )
    guarded = guarded_audit(spark, folder).withColumn("attestation", F.when(e % 3 == 0, given))
    return ingest.accepted_rows(ingest.seal_events(guarded, KEYRING)).select("event_id", "attestation_proof")


@query(
    with_(DOC_META)
    + f"""SELECT doc_id, 'v2' AS key_id, {sealed_length(DOC_PAYLOAD)} > 30720 AS is_claim_check, {DOC_PAYLOAD} AS opened FROM docs"""
)
def reseal_documents(spark, folder):
    """Documents sealed under the old key, opened and sealed again under the new one."""
    old = materialise(sealed_documents(spark, folder, Keyring(KEYRING.keys, "v1")), "old")
    opened = search.open_ledger(search.resolve_claims(ingest.accepted_rows(old), ingest.claim_blobs(old)), KEYRING)
    new = materialise(ingest.reseal(opened, KEYRING), "new")
    rows, blobs = ingest.accepted_rows(new), ingest.claim_blobs(new)
    back = search.open_ledger(search.resolve_claims(rows, blobs), Keyring({"v2": KEYRING.keys["v2"]}, "v2"))
    return back.select(F.col("event_id").alias("doc_id"), sealed_key_id("payload").alias("key_id"), "is_claim_check", "opened")


@query(
    with_(AUDIT, IDENTITIES)
    + """SELECT event_id, who AS actor, action, CAST(k AS BIGINT) AS k FROM ids WHERE tenant = 't_2'"""
)
def ledger_export(spark, folder):
    """One tenant's rows of a stored ledger, opened, exported as CSV and read back."""
    ledger = work_folder(spark, "ledger")
    store.append(sealed_audit(spark, folder), ledger)
    rows = search.search_literals(store.read_rows(spark, ledger), KEYRING, "tenant_index", ["t_2"])
    opened = search.open_ledger(rows, KEYRING)
    part = lambda path, name: F.get_json_object("opened", f"$.{path}").alias(name)
    path = work_folder(spark, "export")
    store.export_csv(opened.select("event_id", part("actor", "actor"), part("action", "action"), part("metadata.k", "k")), path)
    return store.read_csv(spark, path, "event_id bigint, actor string, action string, k bigint")
