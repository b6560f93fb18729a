"""Merkle proofs, hash chains and attestation digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.functions.crypto import GENESIS, sha256_hex
from vaultrail.functions.jsontext import object_of, quote
from vaultrail.functions.numbers import floor_div
from vaultrail.functions.text import first_present

# --- Merkle proofs ---------------------------------------------------------------------------------------------------

# The last steps of a path are tried in both orders at once, the steps before them one order after the other.
BOTH_ORDERS = 10
# Steps up to which the sides of siblings are searched for.
UNSIDED_STEPS = 24


def _fold_both(start: Column, path: Column) -> Column:
    """All hashes reachable when each sibling may stand on either side."""
    return F.aggregate(
        path,
        F.array(start),
        lambda found, sibling: F.concat(
            F.transform(found, lambda h: F.sha2(F.concat(h, sibling), 256)),
            F.transform(found, lambda h: F.sha2(F.concat(sibling, h), 256)),
        ),
    )


def _fold_ordered(start: Column, path: Column, order: Column) -> Column:
    """The hash reached when bit ``i`` of ``order`` says on which side sibling ``i`` stands."""

    def step(acc: Column, sibling: Column) -> Column:
        right = F.sha2(F.concat(acc["h"], sibling), 256)
        left = F.sha2(F.concat(sibling, acc["h"]), 256)
        return F.struct(F.when(acc["o"] % 2 == 0, right).otherwise(left).alias("h"), F.shiftright(acc["o"], 1).alias("o"))

    return F.aggregate(path, F.struct(start.alias("h"), order.cast("bigint").alias("o")), step, lambda acc: acc["h"])


def verify_proofs(proofs: DataFrame, payload: str = "payload", position: str | None = None) -> DataFrame:
    """Add ``valid`` to proofs ``(payload, merkle_root, merkle_path_json)``; a path that is no JSON list is invalid.

    ``position`` names a column with the leaf's place in its tree, from 0. Its bits tell the sides of the siblings, so
    a path of any length takes one hash a step. Where it is null or not given, each sibling may stand on either side, and
    a path of ``n`` steps has ``2^n`` candidate roots. All are tried, within the row and without a shuffle; at no time
    are more than ``2^BOTH_ORDERS`` hashes held, and the first hit ends the search. That work doubles with each step,
    so a path of more than ``UNSIDED_STEPS`` steps without a position is left undecided: its ``valid`` is null.
    """
    ready = proofs.withColumns(
        {"_path": F.from_json("merkle_path_json", "array<string>"), "_leaf": sha256_hex(payload)}
    )
    path, leaf, root = F.col("_path"), F.col("_leaf"), F.col("merkle_root")
    ordered = F.greatest(F.size(path) - BOTH_ORDERS, F.lit(0))
    short = F.size(path) <= BOTH_ORDERS
    tried = F.least(ordered, F.lit(UNSIDED_STEPS - BOTH_ORDERS))
    orders = F.sequence(F.lit(0).cast("bigint"), F.pow(F.lit(2.0), tried).cast("bigint") - 1)
    first, rest = F.slice(path, F.lit(1), ordered), F.slice(path, ordered + 1, F.lit(BOTH_ORDERS))
    long_hit = F.exists(orders, lambda o: F.array_contains(_fold_both(_fold_ordered(leaf, first, o), rest), root))
    either = F.when(short, F.array_contains(_fold_both(leaf, path), root)).otherwise(long_hit)
    at = F.lit(None).cast("bigint") if position is None else F.col(position)
    valid = F.when(at.isNotNull(), _fold_ordered(leaf, path, at) == root).otherwise(either)
    undecided = at.isNull() & (F.size(path) > UNSIDED_STEPS)
    return ready.withColumn("valid", F.when(~F.coalesce(undecided, F.lit(False)), F.coalesce(valid, F.lit(False)))).drop("_path", "_leaf")


# --- hash chains -----------------------------------------------------------------------------------------------------

# Entries in a row of the fold, and from one anchor to the next.
BLOCK = 65_536


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain values of blocks sorted by project and block; of a project only the last value is held."""
    import hashlib

    project, chain = None, None
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            if chain is None or row["project_id"] != project:
                project, chain = row["project_id"], row["head"]
            chained = []
            for value in row["hashes"]:
                chain = hashlib.sha256((chain + value).encode()).hexdigest()
                chained.append(chain)
            columns = [batch.column(n).slice(i, 1) for n in ("project_id", "positions", "hashes")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([chained], pa.list_(pa.string()))], names=["project_id", "positions", "hashes", "chains"])


def build_chain(entries: DataFrame, heads: DataFrame | None = None, block_size: int = BLOCK) -> DataFrame:
    """Chain value of every ledger entry ``(project_id, seq, payload_hash)``, with ``seq`` from 1 and unique: one chain per project.

    ``chain = sha256(previous chain, payload hash)``, from genesis or from the stored ``heads(project_id, seq, chain_hash)``, beyond
    which only entries of higher ``seq`` are taken. Each link needs the one before it, so a project's links are one
    stream; its entries reach it packed in blocks, it holds one value, and projects are worked on side by side. What is
    chained once is not folded again: a later run begins at the heads.
    """
    rows = entries.select("project_id", "seq", F.col("payload_hash").alias("hash"))
    rows = rows.withColumn("head", F.lit(GENESIS))
    if heads is not None:
        known = heads.select("project_id", F.col("seq").alias("_seq"), F.col("chain_hash").alias("_chain"))
        rows = rows.join(known, "project_id", "left").where("_seq is null or seq > _seq")
        rows = rows.withColumn("head", F.coalesce("_chain", "head")).drop("_seq", "_chain")
    packed = (
        rows.groupBy("project_id", floor_div(F.col("seq") - 1, block_size).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("seq", "hash"))).alias("items"), F.first("head").alias("head"))
        .select("project_id", "block", F.col("items.seq").alias("positions"), F.col("items.hash").alias("hashes"), "head")
    )
    ordered = packed.repartition("project_id").sortWithinPartitions("project_id", "block").drop("block")
    project = dict(entries.dtypes)["project_id"]
    folded = ordered.mapInArrow(_fold, f"project_id {project}, positions array<bigint>, hashes array<string>, chains array<string>")
    links = folded.select("project_id", F.explode(F.arrays_zip("positions", "hashes", "chains")).alias("l"))
    return links.select("project_id", F.col("l.positions").alias("seq"), F.col("l.hashes").alias("payload_hash"), F.col("l.chains").alias("chain_hash"))


def chain_heads(chain: DataFrame) -> DataFrame:
    """Last entry of each project: ``(project_id, seq, chain_hash)``."""
    last = F.max(F.struct("seq", "chain_hash")).alias("l")
    return chain.groupBy("project_id").agg(last).select("project_id", "l.seq", "l.chain_hash")


def build_anchors(chain: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """An index beside the chain: the chain value at the end of each block, and a chain over these: ``(project_id, pos, hash, chain)``.

    ``pos`` counts blocks from 0. The last anchor stands for all entries of the project, and each one lets a reader check its
    block without the blocks before it.
    """
    block = floor_div(F.col("seq") - 1, block_size)
    ends = chain.groupBy("project_id", block.alias("pos")).agg(F.max_by("chain_hash", "seq").alias("payload_hash"))
    over = build_chain(ends.select("project_id", (F.col("pos") + 1).alias("seq"), "payload_hash"), block_size=block_size)
    return over.select("project_id", (F.col("seq") - 1).alias("pos"), F.col("payload_hash").alias("hash"), F.col("chain_hash").alias("chain"))


def check_chain(chain: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """First broken link per project and the number of broken links.

    A link is checked against its stored predecessor alone, so the check needs no fold: any change to a hash or a chain
    value shows at that entry or the next. Blocks are checked side by side; the first link of a block finds its
    predecessor among the last ones of blocks.
    """
    block = floor_div(F.col("seq") - 1, block_size)
    inside = Window.partitionBy("project_id", "_block").orderBy("seq")
    linked = chain.select("project_id", "seq", "payload_hash", "chain_hash", block.alias("_block"))
    tails = linked.groupBy("project_id", (F.col("_block") + 1).alias("_block")).agg(F.max(F.struct("seq", "chain_hash")).alias("_tail"))
    linked = linked.withColumn("_before", F.lag(F.struct("seq", "chain_hash")).over(inside)).join(tails, ["project_id", "_block"], "left")
    before = F.coalesce("_before", "_tail")
    previous = F.when(F.col("seq") == 1, F.lit(GENESIS)).when(before["seq"] == F.col("seq") - 1, before["chain_hash"])
    good = F.coalesce(F.col("chain_hash") == F.sha2(F.concat(previous, F.col("payload_hash")), 256), F.lit(False))
    return linked.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("entries"),
        F.min(F.when(~good, F.col("seq"))).alias("first_broken"),
        F.count_if(~good).alias("broken"),
    )


# --- attestations ----------------------------------------------------------------------------------------------------


def attestation_text(action: Column | str, target: Column | str, canonical_metadata: Column) -> Column:
    """Canonical JSON of what a person confirms; absent parts are null."""
    null = F.lit("null")
    return object_of(
        ("action", quote(action)),
        ("metadata", F.coalesce(canonical_metadata, null)),
        ("target", F.coalesce(quote(first_present(target)), null)),
    )


def attestation_digest(challenge: Column | str, text: Column) -> Column:
    """SHA-256 over challenge, a colon and the raw SHA-256 of the canonical text."""
    challenge = F.col(challenge) if isinstance(challenge, str) else challenge
    inner = F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))
    return F.sha2(F.concat(F.encode(challenge, "UTF-8"), F.encode(F.lit(":"), "UTF-8"), inner), 256)


def check_attestations(events: DataFrame, challenges: DataFrame, canonical_metadata: Column) -> DataFrame:
    """Join events to ``challenges(event_id, challenge, digest)`` and compare digests."""
    text = attestation_text("action", "target", canonical_metadata)
    computed = events.withColumn("_text", text).join(challenges, "event_id")
    return computed.withColumn("computed", attestation_digest("challenge", F.col("_text"))).withColumn(
        "matches", F.col("computed") == F.col("digest")
    )
