"""Grants, views, purge, credentials and display names."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultrail.functions.crypto import blind_index
from vaultrail.operators import access, ingest, search
from vaultrail.operators.ordered import int_chunk
from vaultrail.plans import inputs
from vaultrail.plans.inputs import KEYRING
from vaultrail.plans.oracle import AUDIT, IDENTITIES, hmac, with_
from vaultrail.plans.registry import registrar
from vaultrail.plans.sealing import CLOCKS, DOC_META, DOC_PAYLOAD, audit, guarded_audit, sealed_audit, sealed_documents
from vaultrail.session import work_folder
from vaultrail.sources import ledger as store

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)

GRANTS = """requests AS (
    SELECT c_custkey AS c, 'g_' || c_custkey AS grant_id, CASE WHEN c_custkey % 7 <> 0 THEN 'usr_' || (c_custkey % 150) END AS actor_id,
      CASE WHEN c_custkey % 3 = 0 THEN 'obj_' || (c_custkey % 100) END AS target_id, CASE WHEN c_custkey % 2 = 0 THEN 't_' || (c_custkey % 5) END AS tenant_id,
      CASE c_custkey % 5 WHEN 0 THEN 'actor' WHEN 1 THEN 'target' WHEN 2 THEN 'tenant' WHEN 3 THEN 'auditor' END AS asked,
      CASE c_custkey % 6 WHEN 0 THEN 30 WHEN 1 THEN 1800 WHEN 2 THEN 7200 WHEN 3 THEN 86400 ELSE 7200 END AS seconds,
      1700000000 + c_custkey AS iat FROM customer),
  scoped AS (SELECT *, COALESCE(asked, CASE WHEN tenant_id IS NULL THEN 'actor' ELSE 'tenant' END) AS scope FROM requests),
  grants AS (SELECT *, iat + least(seconds, CASE scope WHEN 'auditor' THEN 604800 ELSE 3600 END) AS exp,
      CASE WHEN scope <> 'auditor' AND actor_id IS NULL AND target_id IS NULL AND tenant_id IS NULL THEN 'identity_missing' END AS reject_reason FROM scoped)"""


def grants(spark, folder):
    return access.access_grants(inputs.grants(spark, folder), KEYRING)


def actor_ledger(spark, folder):
    """Ledger index columns with clocks, without sealing."""
    key = F.col("_key")
    clocked = ingest.assign_clocks(guarded_audit(spark, folder), [int_chunk("event_id")])
    return KEYRING.attach(clocked).select(
        "event_id",
        "created_at",
        "logical_clock",
        blind_index(ingest.indexed_identity("actor"), key).alias("actor_index"),
        blind_index(ingest.indexed_identity("target"), key).alias("target_index"),
        blind_index(ingest.indexed_identity("tenant", None), key).alias("tenant_index"),
    )


@query(
    with_(GRANTS)
    + f"""SELECT grant_id, scope, iat, exp, reject_reason, {hmac('actor_id', 'v1')} AS actor_v1, {hmac('actor_id', 'v2')} AS actor_v2,
      {hmac('tenant_id', 'v2')} AS tenant_v2 FROM grants"""
)
def access_grants(spark, folder):
    return grants(spark, folder).select(
        "grant_id",
        "scope",
        "iat",
        "exp",
        "reject_reason",
        F.col("actor_indexes")[0].alias("actor_v1"),
        F.col("actor_indexes")[1].alias("actor_v2"),
        F.col("tenant_indexes")[1].alias("tenant_v2"),
    )


NOW = 1_700_002_500


@query(
    with_(AUDIT, IDENTITIES, CLOCKS, GRANTS)
    + f"""SELECT grant_id, scope, count(event_id) AS rows, min(logical_clock) AS first_clock, max(logical_clock) AS last_clock FROM grants g
      LEFT JOIN ledger l ON (scope = 'actor' AND l.who = g.actor_id) OR (scope = 'target' AND l.target = g.target_id)
        OR (scope = 'tenant' AND l.tenant = g.tenant_id) OR scope IN ('all', 'auditor')
      WHERE reject_reason IS NULL AND exp > {NOW} GROUP BY grant_id, scope"""
)
def grant_rows(spark, folder):
    """What each live grant may see: rows and clock range."""
    live = access.live_grants(grants(spark, folder), F.lit(NOW))
    return access.grant_coverage(actor_ledger(spark, folder), live)


@query(
    with_(AUDIT, IDENTITIES, GRANTS)
    + f"""SELECT event_id FROM ids WHERE who IN (SELECT actor_id FROM grants WHERE scope = 'actor' AND reject_reason IS NULL AND exp > {NOW})"""
)
def visible_rows(spark, folder):
    """Rows at least one live actor grant may see."""
    live = access.live_grants(grants(spark, folder), F.lit(NOW))
    return access.rows_visible_to(actor_ledger(spark, folder), live, "actor").select("event_id")


REACH = (
    f"""live AS (SELECT *, 'p_' || (c % 3) AS project_id FROM grants WHERE reject_reason IS NULL AND exp > {NOW})""",
    """pairs AS (
    SELECT grant_id, g.actor_id AS holder, g.project_id, scope, event_id FROM live g JOIN (SELECT *, 'p_' || (event_id % 3) AS project_id FROM ids) l ON l.project_id = g.project_id
      AND ((scope = 'actor' AND l.who = g.actor_id) OR (scope = 'target' AND l.target = g.target_id) OR (scope = 'tenant' AND l.tenant = g.tenant_id) OR scope IN ('all', 'auditor')))""",
)


def project_grants(spark, folder):
    """Ledger rows and live grants of three projects."""
    ledger = actor_ledger(spark, folder).withColumn("project_id", inputs.text("p_", F.col("event_id") % 3))
    requests = inputs.grants(spark, folder).withColumn("project_id", inputs.text("p_", F.substring("grant_id", 3, 20).cast("bigint") % 3))
    return ledger, access.live_grants(access.access_grants(requests, KEYRING), F.lit(NOW))


@query(
    with_(AUDIT, IDENTITIES, GRANTS, *REACH)
    + "SELECT grant_id, project_id, scope, count(event_id)::BIGINT AS rows FROM live LEFT JOIN pairs USING (grant_id, project_id, scope) GROUP BY ALL"
)
def grant_reach(spark, folder):
    """Rows each live grant may see within its project, for every scope."""
    ledger, live = project_grants(spark, folder)
    counted = access.grant_counts(ledger, live)
    return live.select("grant_id", "project_id", "scope").join(counted, "grant_id", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


@query(
    with_(AUDIT, IDENTITIES, GRANTS, *REACH)
    + "SELECT holder, project_id, count(DISTINCT event_id)::BIGINT AS rows FROM pairs WHERE holder IS NOT NULL GROUP BY ALL"
)
def holder_reach(spark, folder):
    """Rows that all live grants of one holder reach together, each counted once."""
    ledger, live = project_grants(spark, folder)
    holders = live.where("actor_id is not null").withColumnRenamed("actor_id", "holder")
    return access.group_counts(ledger, live, holders, ["holder", "project_id"])


@query(
    with_(AUDIT, IDENTITIES, GRANTS, *REACH)
    + "SELECT DISTINCT event_id FROM pairs WHERE scope <> 'auditor' OR grant_id = 'g_3'"
)
def rows_in_reach(spark, folder):
    """Rows that any live grant reaches, with one auditor of one project among them."""
    ledger, live = project_grants(spark, folder)
    return access.rows_visible_to(ledger, live.where("scope <> 'auditor' or grant_id = 'g_3'")).select("event_id")


@query(
    with_(AUDIT, IDENTITIES)
    + """SELECT event_id, who AS act, action AS acn, target AS tgt, k AS "m.k", strftime(created_at, '%Y-%m-%d %H:%M:%S') AS cat
      FROM ids WHERE tenant = 't_1' AND action = 'event.error' AND contains(target, 'obj_7')"""
)
def scoped_view(spark, folder):
    """A tenant's view of a stored ledger with chosen columns, an action filter and a text search."""
    path = work_folder(spark, "ledger")
    store.append(sealed_audit(spark, folder), path)
    ledger = store.read_rows(spark, path)
    columns = ["createdAt", "actor", "action", "target", "metadata.k"]
    view = search.scoped_view(ledger, KEYRING, "tenant", ["t_1"], columns, search='"target":"obj_7', action="event.error")
    return view.withColumn("cat", F.date_format("cat", "yyyy-MM-dd HH:mm:ss"))


@query(
    with_(AUDIT, IDENTITIES)
    + """SELECT event_id FROM ids WHERE who IN (SELECT 'usr_' || (c_custkey * 3) FROM customer)"""
)
def search_table(spark, folder):
    """Events of the actors listed in a table."""
    wanted = inputs.table(spark, folder, "customer").select(inputs.text("usr_", F.col("c_custkey") * 3).alias("actor"))
    return search.search_values(actor_ledger(spark, folder), KEYRING, "actor_index", wanted, "actor").select("event_id")


@query(
    with_(AUDIT, IDENTITIES)
    + """SELECT event_id, actor IS NOT NULL AND user_id % 4 <> 0 AS resolved,
      CASE WHEN actor IS NOT NULL AND user_id % 4 <> 0 THEN 'Customer ' || user_id END AS display_name FROM ids"""
)
def hydrate_refs(spark, folder):
    """Display names of referenced actors; events without one have none."""
    policy = ingest.IngestPolicy(reference=("actor",))
    rows = audit(spark, folder).select("event_id", ingest.stored_identity("actor", policy).alias("actor"))
    user = F.col("user_id")
    people = inputs.users(spark, folder).where(user % 4 != 0).select(
        inputs.text("usr_", user).alias("ref_id"), inputs.text("Customer ", user).alias("display_name")
    )
    named = search.hydrate(rows, "actor", people)
    return named.select("event_id", F.col("display_name").isNotNull().alias("resolved"), "display_name")


@query(
    with_(AUDIT, IDENTITIES)
    + "SELECT DISTINCT who AS ref_id FROM ids"
)
def reference_ids(spark, folder):
    """Distinct ids that have to be resolved."""
    policy = ingest.IngestPolicy(reference=("actor",))
    rows = audit(spark, folder).select(ingest.stored_identity("actor", policy).alias("actor"))
    return search.referenced_ids(rows, "actor")


PURGE = """requests AS (
    SELECT 'usr_' || c_custkey AS who, max(until) AS until, bool_or(until IS NULL) AS everything FROM (
      SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN TIMESTAMP '2024-01-15 00:00:00' END AS until FROM customer) GROUP BY 1),
  marked AS (SELECT ids.*, requests.who IS NOT NULL AND (everything OR created_at <= until) AS purged FROM ids LEFT JOIN requests USING (who))"""


def purged(spark, folder):
    c = F.col("c_custkey")
    wanted = inputs.table(spark, folder, "customer").select(
        inputs.text("usr_", c).alias("actor"),
        F.when(c % 3 != 0, F.lit("2024-01-15 00:00:00").cast("timestamp")).alias("max_created_at"),
    )
    return access.mark_purged(actor_ledger(spark, folder), wanted, KEYRING)


@query(with_(AUDIT, IDENTITIES, PURGE) + "SELECT event_id, COALESCE(purged, false) AS purged FROM marked")
def purge_actor(spark, folder):
    """Which rows a list of purge requests covers, some of them up to a time only."""
    return purged(spark, folder).select("event_id", "purged")


@query(with_(AUDIT, IDENTITIES, PURGE) + f"SELECT {hmac('who')} AS actor_index, count(*) AS deleted_count FROM marked WHERE purged GROUP BY who")
def purge_counts(spark, folder):
    return access.purge_counts(purged(spark, folder))


def purged_documents(spark, folder):
    """Folder of a document ledger's next snapshot: sources whose smallest doc_id is even asked to be erased."""
    path, snapshot = work_folder(spark, "ledger"), work_folder(spark, "snapshot")
    store.append(sealed_documents(spark, folder), path)
    smallest = inputs.table(spark, folder, "documents").groupBy(F.col("source").alias("actor")).agg(F.min("doc_id").alias("lowest"))
    wanted = smallest.where("lowest % 2 = 0").select("actor", F.lit(None).cast("timestamp").alias("max_created_at"))
    store.purge(spark, path, snapshot, wanted, KEYRING)
    return snapshot


ERASED = "erased AS (SELECT source FROM documents GROUP BY source HAVING min(doc_id) % 2 = 0)"


@query(with_(DOC_META, ERASED) + f"SELECT doc_id, {DOC_PAYLOAD} AS opened FROM docs WHERE source NOT IN (SELECT source FROM erased)")
def purge_snapshot(spark, folder):
    """Documents that a purge leaves, opened from the snapshot's own rows and blobs."""
    snapshot = purged_documents(spark, folder)
    rows = search.resolve_claims(store.read_rows(spark, snapshot), store.read_blobs(spark, snapshot))
    return search.open_ledger(rows, KEYRING).select(F.col("event_id").alias("doc_id"), "opened")


@query(with_(ERASED) + f"SELECT doc_id, {hmac('source')} AS actor_index FROM documents WHERE source IN (SELECT source FROM erased)")
def purge_tombstones(spark, folder):
    """What is known of purged documents: their ids and whose they were."""
    rows = store.read_tombstones(spark, purged_documents(spark, folder))
    return rows.select(F.col("event_id").alias("doc_id"), "actor_index")


CRC = """list_reduce(range(0, 160), lambda c, i: xor(c >> 1, CASE WHEN (xor(c, (ascii(substr(BODY, CAST(i // 8 + 1 AS BIGINT), 1)) >> CAST(i % 8 AS INTEGER))::BIGINT) & 1) = 1
  THEN 3988292384 ELSE 0 END), CAST(4294967295 AS BIGINT))"""


@query(
    """WITH c AS (SELECT *, substr(sha256(c_custkey::VARCHAR), 1, 20) AS body, substr(sha256(c_name), 1, 6) AS tail FROM customer),
    s AS (SELECT *, substr(lpad(lower(hex(xor("""
    + CRC.replace("BODY", "body")
    + """, 4294967295))), 8, '0'), 1, 6) AS good FROM c)
    SELECT c_custkey AS credential_id, good AS expected, NOT (c_custkey % 7 <> 0 AND c_custkey % 11 = 0) AS well_formed,
      NOT (c_custkey % 7 <> 0 AND c_custkey % 11 = 0) AND (c_custkey % 7 <> 0 OR tail = good) AS checksum_ok, c_custkey % 4 <> 3 AS known_class,
      c_custkey % 4 = 0 AS handover FROM s"""
)
def credential_audit(spark, folder):
    """Credential format, checksum and use."""
    rows = inputs.credentials(spark, folder)
    audited = access.audit_credentials(rows)
    body = F.substring(F.sha2(F.col("credential_id").cast("string"), 256), 1, 20)
    return audited.select(
        "credential_id", access.checksum(body).alias("expected"), "well_formed", "checksum_ok", "known_class", "handover"
    )
