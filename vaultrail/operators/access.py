"""Access grants, what they may see, purge and credential checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultrail.functions.crypto import Keyring, blind_indexes
from vaultrail.functions.text import IDENTITY_LIMIT, present, truncate
from vaultrail.operators.search import index_values

# Grant lifetimes in seconds.
DEFAULT_LIFETIME = 7200
LIFETIME_CAP = 3600
AUDITOR_CAP = 604800
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}

# Credential format and the contexts each class may be used in.
CREDENTIAL_PATTERN = r"^val_live_([a-f0-9]{20})([a-f0-9]{6})$"
CREDENTIAL_CLASSES = ["human", "agent", "service"]


def lifetime_seconds(duration: Column | str) -> Column:
    """Seconds of ``30s``, ``15m``, ``2h`` or ``7d``; anything else is the default lifetime."""
    pattern = r"^(\d+)(s|m|h|d)$"
    number = F.regexp_extract(duration, pattern, 1).try_cast("bigint")
    unit = F.regexp_extract(duration, pattern, 2)
    factor = F.when(unit == "s", 1)
    for name in ("m", "h", "d"):
        factor = factor.when(unit == name, UNIT_SECONDS[name])
    return F.coalesce(number * factor, F.lit(DEFAULT_LIFETIME)).cast("bigint")


def access_grants(requests: DataFrame, keyring: Keyring) -> DataFrame:
    """Grant rows from requests ``(grant_id, actor_id, target_id, tenant_id, scope, expires_in, iat)``.

    A request needs one identity unless its scope is auditor; ``reject_reason`` marks the others. Each identity is
    indexed under every key of the ring.
    """
    names = ["actor", "target", "tenant"]
    given = {n: present(f"{n}_id") for n in names}
    scope = F.coalesce(present("scope"), F.when(given["tenant"].isNotNull(), "tenant").otherwise("actor"))
    nobody = given["actor"].isNull() & given["target"].isNull() & given["tenant"].isNull()
    cap = F.when(F.col("scope") == "auditor", AUDITOR_CAP).otherwise(LIFETIME_CAP)
    lifetime = F.least(lifetime_seconds(F.coalesce("expires_in", F.lit(f"{DEFAULT_LIFETIME}s"))), cap)
    indexes = {f"{n}_indexes": blind_indexes(truncate(given[n], IDENTITY_LIMIT), F.col("_keys")) for n in names}
    return (
        keyring.attach_all(requests)
        .withColumn("scope", scope)
        .withColumns(indexes)
        .withColumn("exp", F.col("iat") + lifetime)
        .withColumn("reject_reason", F.when((F.col("scope") != "auditor") & nobody, "identity_missing"))
        .drop("_keys")
    )


def live_grants(grants: DataFrame, now: Column) -> DataFrame:
    return grants.where(F.col("reject_reason").isNull() & (F.col("exp") > now))


WIDE = ["all", "auditor"]


def _project(df: DataFrame) -> Column:
    """Project of a ledger row or grant; a table without that column is one project."""
    return F.coalesce(df["project_id"].cast("string"), F.lit("")) if "project_id" in df.columns else F.lit("")


def _row_tokens(ledger: DataFrame) -> Column:
    """What a grant of each scope would have to name to see a row."""
    named = [F.struct(F.lit(n).alias("scope"), F.col(f"{n}_index").alias("token")) for n in ("actor", "target", "tenant")]
    return F.filter(F.array(*named, F.struct(F.lit("all").alias("scope"), F.lit("*").alias("token"))), lambda t: t["token"].isNotNull())


def grant_tokens(grants: DataFrame) -> DataFrame:
    """``(grant_id, project_id, scope, token)`` of what each grant names; wide scopes name all rows of their project."""
    chosen = F.when(F.col("scope").isin(WIDE), F.array(F.lit("*")))
    for name in ("actor", "target", "tenant"):
        chosen = chosen.when(F.col("scope") == name, F.col(f"{name}_indexes"))
    scope = F.when(F.col("scope").isin(WIDE), "all").otherwise(F.col("scope"))
    return grants.select("grant_id", _project(grants).alias("project_id"), scope.alias("scope"), F.explode(chosen).alias("token"))


def rows_visible_to(ledger: DataFrame, grants: DataFrame, scope: str | None = None) -> DataFrame:
    """Ledger rows at least one of the given grants may see, each once; of one scope, or of all.

    A grant sees rows of its own project only; the scopes ``all`` and ``auditor`` see all of these. Ledger and grants without
    ``project_id`` are one project. ``event_id`` names the rows; grants become a set of tokens first, and rows meet it with
    their tokens alone.
    """
    wanted = grant_tokens(grants if scope is None else grants.where(F.col("scope") == scope)).select("project_id", "scope", "token").distinct()
    held = ledger.select("event_id", _project(ledger).alias("project_id"), F.explode(_row_tokens(ledger)).alias("t"))
    seen = held.select("event_id", "project_id", "t.scope", "t.token").join(wanted, ["project_id", "scope", "token"], "left_semi")
    return ledger.join(seen.select("event_id").distinct(), "event_id", "left_semi")


def grant_bitmaps(ledger: DataFrame, grants: DataFrame) -> DataFrame:
    """Which rows each grant may see: ``(grant_id, bucket, rows)``, a bitmap of ``event_id`` per bucket of 32,768 ids.

    The ledger is reduced to bitmaps per project and token first, so grants over the same tenant share its bitmaps until they
    are joined. A row that several of a grant's tokens name is one bit; any union of grants is one more ``bitmap_or_agg``. Its size is
    grants times buckets, so it is for few grants; :func:`grant_counts` and :func:`group_counts` count for any number of them.
    """
    held = ledger.select("event_id", _project(ledger).alias("project_id"), F.explode(_row_tokens(ledger)).alias("t"))
    per_token = held.groupBy("project_id", "t.scope", "t.token", F.bitmap_bucket_number("event_id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("event_id")).alias("rows"))
    met = grant_tokens(grants).join(per_token, ["project_id", "scope", "token"])
    return met.groupBy("grant_id", "bucket").agg(F.bitmap_or_agg("rows").alias("rows"))


def reach(bitmaps: DataFrame, holders: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """Number of rows each grant may see, or each group ``by`` of grants together, every row counted once.

    ``holders`` has ``grant_id`` and the ``by`` columns.
    """
    if holders is None:
        return bitmaps.groupBy("grant_id").agg(F.sum(F.bitmap_count("rows")).alias("rows"))
    merged = bitmaps.join(holders.select("grant_id", *by), "grant_id").groupBy(*by, "bucket").agg(F.bitmap_or_agg("rows").alias("rows"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("rows")).alias("rows"))


SCOPED = ["actor", "target", "tenant"]


def _repeats(ledger: DataFrame) -> DataFrame:
    """The ids that more than one row has."""
    return ledger.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("event_id")


def _named_rows(ledger: DataFrame) -> DataFrame:
    """What tokens need of rows that can be counted: id, project and the three indexes."""
    return ledger.where("event_id is not null").select("event_id", _project(ledger).alias("project_id"), *(F.col(f"{n}_index") for n in SCOPED))


def grant_counts(ledger: DataFrame, grants: DataFrame) -> DataFrame:
    """``(grant_id, rows)``: rows each grant may see, every row counted once, for grants that see any.

    A row has one index per scope, so tokens of one grant name different rows and their counts are added. Ids that several rows
    have are left to :func:`_pairs`.
    """
    rows, wanted = _named_rows(ledger), grant_tokens(grants).distinct()
    once = rows.join(_repeats(rows), "event_id", "left_anti")
    tokens = once.select("project_id", F.explode(_row_tokens(once)).alias("t"))
    per_token = tokens.groupBy("project_id", "t.scope", "t.token").agg(F.count(F.lit(1)).alias("rows"))
    met = wanted.join(per_token, ["project_id", "scope", "token"]).select("grant_id", "rows")
    more = _pairs(rows, wanted, ["grant_id"])
    return met.unionByName(more).groupBy("grant_id").agg(F.sum("rows").alias("rows"))


def _pairs(rows: DataFrame, held: DataFrame, by: list[str]) -> DataFrame:
    """``(by, rows)`` over the rows whose id is not theirs alone, by the pairs of a group and an id."""
    repeated = rows.join(_repeats(rows), "event_id", "left_semi")
    tokens = repeated.select("event_id", "project_id", F.explode(_row_tokens(repeated)).alias("t")).select("event_id", "project_id", "t.scope", "t.token")
    return held.join(tokens, ["project_id", "scope", "token"]).select(*by, "event_id").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def group_counts(ledger: DataFrame, grants: DataFrame, holders: DataFrame, by: list[str]) -> DataFrame:
    """``(by, rows)``: rows that the grants of each group reach together, every row counted once, for groups that reach any.

    ``holders`` has ``grant_id`` and the ``by`` columns. Groups meet numbers of rows, not rows: the ledger is counted by its indexes,
    by pairs and by triples of them, and the rows of a union are those of its tokens less those of its pairs of tokens, plus those
    of its triples. A combination meets the groups that hold its actor (else its target) first, which is the scope with the fewest rows.
    """
    # Groups are told apart by text, where null is a value as any other.
    named = holders.select("grant_id", F.to_json(F.struct(*by), {"ignoreNullFields": "false"}).alias("_group"), *by)
    groups = named.groupBy("_group").agg(*(F.first(c).alias(c) for c in by))
    held = named.select("grant_id", "_group").join(grant_tokens(grants), "grant_id").select("_group", "project_id", "scope", "token").distinct()
    rows = _named_rows(ledger)
    once = rows.join(_repeats(rows), "event_id", "left_anti")
    profiles = once.groupBy("project_id", *(f"{n}_index" for n in SCOPED)).agg(F.count(F.lit(1)).alias("n"))
    # Indexes that no group holds are as good as none, so that combinations are those of held tokens only.
    wanted = held.select("project_id", "scope", "token").distinct()
    for name in SCOPED:
        own = wanted.where(F.col("scope") == name).select("project_id", F.col("token").alias(f"{name}_index"), F.col("token").alias(name))
        profiles = profiles.join(own, ["project_id", f"{name}_index"], "left")
    profiles = profiles.groupBy("project_id", *SCOPED).agg(F.sum("n").alias("n"))
    kinds = [[n for i, n in enumerate(SCOPED) if mask >> i & 1] for mask in range(8)]
    tokens = lambda kind: F.array(*[F.struct(F.lit(n).alias("scope"), F.col(n).alias("token")) for n in kind] or [F.struct(F.lit("all").alias("scope"), F.lit("*").alias("token"))])
    every = F.filter(F.array(*[tokens(kind) for kind in kinds]), lambda c: F.forall(c, lambda t: t["token"].isNotNull()))
    counted = profiles.select("project_id", F.explode(every).alias("c"), "n").groupBy("project_id", "c").agg(F.sum("n").alias("n"))
    part = lambda i, field: F.get("c", F.lit(i))[field]
    counted = counted.select("project_id", "n", F.size("c").alias("parts"), *(part(i, f).alias(f"{f}_{i}") for i in range(3) for f in ("scope", "token")))
    met = counted.withColumnsRenamed({"scope_0": "scope", "token_0": "token"}).join(held, ["project_id", "scope", "token"])
    for i in (1, 2):
        other = held.withColumnsRenamed({"scope": f"scope_{i}", "token": f"token_{i}"})
        single, joint = met.where(F.col("parts") <= i), met.where(F.col("parts") > i)
        met = single.unionByName(joint.join(other, ["_group", "project_id", f"scope_{i}", f"token_{i}"], "left_semi"))
    signed = F.when(F.col("parts") % 2 == 1, F.col("n")).otherwise(-F.col("n"))
    whole = F.col("scope") == "all"
    summed = met.groupBy("_group", "project_id").agg(F.max(F.when(whole, F.col("n"))).alias("all"), F.sum(F.when(~whole, signed)).alias("some"))
    found = summed.select("_group", F.coalesce("all", "some").alias("rows")).unionByName(_pairs(rows, held, ["_group"]))
    return found.groupBy("_group").agg(F.sum("rows").alias("rows")).join(groups, "_group").select(*by, "rows")


def grant_coverage(ledger: DataFrame, grants: DataFrame) -> DataFrame:
    """Per grant the number of rows it may see and their clock range.

    The ledger is reduced to one row per index before grants meet it, so a grant over a large tenant costs as much as
    one over a small actor.
    """
    measures = [
        F.count(F.lit(1)).alias("rows"),
        F.min("logical_clock").alias("first_clock"),
        F.max("logical_clock").alias("last_clock"),
    ]
    scoped = ["actor", "target", "tenant"]
    tokens = F.array(*[F.struct(F.lit(n).alias("scope"), F.col(f"{n}_index").alias("token")) for n in scoped])
    indexed = ledger.select("logical_clock", F.explode(tokens).alias("i")).where(F.col("i.token").isNotNull())
    per_index = indexed.groupBy("i.scope", "i.token").agg(*measures)
    chosen = F.col("actor_indexes")
    for name in ("target", "tenant"):
        chosen = F.when(F.col("scope") == name, F.col(f"{name}_indexes")).otherwise(chosen)
    narrow = grants.where(F.col("scope").isin(scoped)).select("grant_id", "scope", F.explode_outer(chosen).alias("token"))
    matched = narrow.join(per_index, ["scope", "token"], "left").groupBy("grant_id", "scope").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.min("first_clock").alias("first_clock"),
        F.max("last_clock").alias("last_clock"),
    )
    everything = ledger.agg(F.struct(*measures).alias("all")).select("all").scalar()
    wide = grants.where(F.col("scope").isin("all", "auditor")).withColumn("all", everything)
    return matched.unionByName(wide.select("grant_id", "scope", "all.rows", "all.first_clock", "all.last_clock"))


# --- purge -----------------------------------------------------------------------------------------------------------


def mark_purged(ledger: DataFrame, requests: DataFrame, keyring: Keyring, active_only: bool = False) -> DataFrame:
    """Flag ledger rows that purge requests ``(actor, max_created_at)`` cover; a null bound covers all times.

    Requests for the same actor are merged first, so each row meets at most one of them.
    """
    ring = Keyring({keyring.active_id: keyring.keys[keyring.active_id]}, keyring.active_id) if active_only else keyring
    unbounded = F.max(F.col("max_created_at").isNull())
    merged = (
        index_values(requests, "actor", ring, "actor_index")
        .groupBy("actor_index")
        .agg(F.max("max_created_at").alias("_until"), unbounded.alias("_all"))
    )
    joined = ledger.join(merged, "actor_index", "left")
    covered = F.coalesce(F.col("_all") | (F.col("created_at") <= F.col("_until")), F.lit(False))
    return joined.withColumn("purged", covered).drop("_until", "_all")


def kept_rows(marked: DataFrame) -> DataFrame:
    """The next snapshot of the ledger."""
    return marked.where(~F.col("purged")).drop("purged")


def tombstones(marked: DataFrame) -> DataFrame:
    return marked.where("purged").select("event_id", "actor_index", "created_at")


def purge_counts(marked: DataFrame) -> DataFrame:
    """Deleted rows per actor index."""
    return marked.where("purged").groupBy("actor_index").agg(F.count(F.lit(1)).alias("deleted_count"))


# --- credentials -----------------------------------------------------------------------------------------------------


def checksum(text: Column) -> Column:
    """First six hex digits of the CRC-32 of a text."""
    return F.substring(F.lpad(F.lower(F.hex(F.crc32(F.encode(text, "UTF-8")))), 8, "0"), 1, 6)


def audit_credentials(credentials: DataFrame, key: str = "key", context: str = "context", owner: str = "owner_class") -> DataFrame:
    """Format, checksum and use of credentials.

    ``owner_class`` is ``human``, ``agent`` or ``service``; a human credential used in an agent context is flagged.
    """
    body, embedded = F.regexp_extract(key, CREDENTIAL_PATTERN, 1), F.regexp_extract(key, CREDENTIAL_PATTERN, 2)
    formed = body != ""
    return credentials.withColumns(
        {
            "well_formed": formed,
            "checksum_ok": formed & (embedded == checksum(body)),
            "known_class": F.col(owner).isin(CREDENTIAL_CLASSES),
            "handover": (F.col(owner) == "human") & (F.col(context) == "agent"),
        }
    )
