"""Reading a sealed ledger: blind-index search, opening, claim checks, scoped views, causality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vaultrail.functions.crypto import Keyring, blind_indexes, open_sealed, sealed_key_id
from vaultrail.functions.text import IDENTITY_LIMIT, truncate
from vaultrail.session import materialise


def search_literals(ledger: DataFrame, keyring: Keyring, index: str, values: list[str]) -> DataFrame:
    """Rows whose index matches any of the given values under any key of the ring, by an IN filter at the scan.

    Any number of values works; :func:`search_values` takes them from a table.
    """
    cut = [v if len(v) <= IDENTITY_LIMIT else v[:IDENTITY_LIMIT] + "..." for v in values]
    return ledger.where(F.col(index).isin([token for v in cut for token in keyring.tokens(v)]))


def index_values(values: DataFrame, value: str, keyring: Keyring, out: str = "token") -> DataFrame:
    """One row per value and key, with the value's blind index under that key."""
    tokens = F.explode(blind_indexes(truncate(value, IDENTITY_LIMIT), F.col("_keys")))
    return keyring.attach_all(values).withColumn(out, tokens).drop("_keys")


def search_values(ledger: DataFrame, keyring: Keyring, index: str, values: DataFrame, value: str) -> DataFrame:
    """Rows whose index matches any value of a table under any key; the ledger is never widened by the match."""
    tokens = index_values(values.select(value), value, keyring).select(F.col("token").alias(index)).dropDuplicates()
    return ledger.join(tokens, index, "left_semi")


# --- opening ---------------------------------------------------------------------------------------------------------


def resolve_claims(ledger: DataFrame, blobs: DataFrame) -> DataFrame:
    """Put the stored sealed text back into claim-checked rows.

    Only flagged rows take part in the join; the others pass by without a shuffle. A blob stored several times counts
    once.
    """
    blobs = blobs.select("hash", "blob").dropDuplicates(["hash"])
    inline = ledger.where(~F.col("is_claim_check"))
    checked = ledger.where(F.col("is_claim_check"))
    found = checked.join(blobs, checked["payload"] == blobs["hash"], "left")
    resolved = found.withColumn("payload", F.coalesce("blob", "payload")).drop("hash", "blob")
    return inline.unionByName(resolved)


def open_ledger(ledger: DataFrame, keyring: Keyring) -> DataFrame:
    """Add ``opened`` (payload JSON) and ``agent`` (agent context JSON); null where a row cannot be opened."""
    keys = F.col("_data_keys")
    opened = {"opened": open_sealed("payload", keys), "agent": open_sealed("agent_context", keys)}
    return keyring.attach_data_keys(ledger).withColumns(opened).drop("_data_keys")


def key_report(ledger: DataFrame) -> DataFrame:
    """Rows per sealing key, the progress report of a key rotation."""
    return ledger.groupBy(sealed_key_id("payload").alias("key_id")).agg(F.count(F.lit(1)).alias("rows"))


# --- views -----------------------------------------------------------------------------------------------------------

# Short codes of view columns.
COLUMN_CODES = {"createdAt": "cat", "actor": "act", "action": "acn", "target": "tgt"}
METADATA_CODE = "m."


def column_code(name: str) -> str:
    if name.startswith("metadata."):
        return METADATA_CODE + name.removeprefix("metadata.")
    return COLUMN_CODES.get(name, name)


def view_column(name: str) -> Column:
    if name == "createdAt":
        return F.col("created_at")
    return F.get_json_object("opened", f"$.{name}")


def scoped_view(
    ledger: DataFrame,
    keyring: Keyring,
    scope: str,
    values: list[str],
    columns: list[str],
    search: str | None = None,
    action: str | None = None,
) -> DataFrame:
    """What a scoped reader sees: rows of the scope, opened, filtered and cut to the view's columns.

    Scope ``actor``, ``target`` or ``tenant`` filters on that index before anything is opened; ``all`` and ``auditor``
    see every row. ``action`` filters on the index as well; ``search`` looks into the opened payload.
    """
    rows = ledger
    if scope in ("actor", "target", "tenant"):
        rows = search_literals(rows, keyring, f"{scope}_index", values)
    elif scope not in ("all", "auditor"):
        raise ValueError(f"unknown scope {scope!r}")
    if action is not None:
        rows = search_literals(rows, keyring, "action_index", [action])
    opened = open_ledger(rows, keyring)
    if search is not None:
        opened = opened.where(F.contains(F.lower("opened"), F.lower(F.lit(search))))
    return opened.select("event_id", *[view_column(c).alias(column_code(c)) for c in columns])


def hydrate(rows: DataFrame, field: str, people: DataFrame, key: str = "ref_id") -> DataFrame:
    """Resolve ``[REF:id]`` values against a table of display names with unique ``key``."""
    marked = rows.withColumn(key, F.nullif(F.regexp_extract(field, r"^\[REF:(.*)\]$", 1), F.lit("")))
    return marked.join(people, key, "left")


def referenced_ids(rows: DataFrame, field: str, key: str = "ref_id") -> DataFrame:
    """Distinct ids to resolve."""
    found = F.nullif(F.regexp_extract(field, r"^\[REF:(.*)\]$", 1), F.lit(""))
    return rows.select(found.alias(key)).where(F.col(key).isNotNull()).dropDuplicates()


# --- causality -------------------------------------------------------------------------------------------------------


def _write_state(state: DataFrame) -> tuple[DataFrame, int, int]:
    """Write one round's pointers; also the number of rows still pointing somewhere, and of all rows."""
    seen = Observation()
    counts = [F.count_if(F.col("next").isNotNull()).alias("open"), F.count(F.lit(1)).alias("rows")]
    written = materialise(state.observe(seen, *counts), "causality")
    return written, seen.get["open"], seen.get["rows"]


def causality(spans: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Root and depth of every span in its tree of span and parent span; ids are looked up within ``scope``, the trace.

    Each round replaces a span's ancestor pointer by its ancestor's pointer, so a chain of ``n`` spans is resolved in
    ``log2(n)`` joins. A span whose parent is not in the table is a root. Spans in a cycle, or below one, end with a
    null root and depth. A span reported several times counts once, under its smallest parent; rows without a span id
    or a scope have neither root nor depth.
    """
    whole = reduce(and_, [F.col(c).isNotNull() for c in [*scope, "span_id"]])
    edges = spans.where(whole).groupBy(*scope, "span_id").agg(F.min("parent_span_id").alias("parent_span_id"))
    known = edges.select(*scope, F.col("span_id").alias("parent_span_id"))
    rooted = edges.join(known.withColumn("_known", F.lit(True)), [*scope, "parent_span_id"], "left")
    has_parent = F.col("_known").isNotNull()
    state = rooted.select(
        *scope,
        "span_id",
        F.when(has_parent, F.col("parent_span_id")).alias("next"),
        F.when(has_parent, F.col("parent_span_id")).otherwise(F.col("span_id")).alias("root"),
        F.when(has_parent, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("depth"),
    )
    state, open_rows, total = _write_state(state)
    rounds = 0
    while open_rows and 2**rounds < total:
        up = state.select(
            *scope,
            F.col("span_id").alias("next"),
            F.col("next").alias("_next"),
            F.col("root").alias("_root"),
            F.col("depth").alias("_depth"),
        )
        pending = state.where(F.col("next").isNotNull()).join(up, [*scope, "next"])
        stepped = pending.select(
            *scope,
            "span_id",
            F.col("_next").alias("next"),
            F.col("_root").alias("root"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
        )
        state, open_rows, total = _write_state(state.where(F.col("next").isNull()).unionByName(stepped))
        rounds += 1
    open_end = F.col("next").isNotNull()
    placed = state.select(
        *scope,
        "span_id",
        F.when(~open_end, F.col("root")).alias("root_span_id"),
        F.when(~open_end, F.col("depth")).alias("depth"),
    )
    return spans.join(placed, [*scope, "span_id"], "left")


def causal_order(rows: DataFrame, scope: list[str]) -> DataFrame:
    """Rows by scope and logical clock; the sort is spread by ranges, so a large scope spans several tasks."""
    return rows.orderBy(*scope, "logical_clock", "event_id")
