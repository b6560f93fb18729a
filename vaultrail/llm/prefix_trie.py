"""The prefix trie of conversations, counted in hash-addressed node tables.

A node is a distinct sequence of first turns. It is named by two 64-bit digests, each the exclusive or of one hash per turn and
position, so the digests of all prefixes are a running aggregate and that of the parent follows from the turn alone.
Nodes with equal digests must agree in depth, parent digest and last turn (SHA-256), which makes their sequences equal by
induction; a disagreement is a collision, and everything is digested anew with another salt.

What a node says of its own members (their number, the smallest, how many end there) is one aggregation. What it says of its
subtree is counted in shards. A node belongs to its smallest member, and a shard holds the whole paths of some of these
conversations: its distinct prefixes get the slots of a minimal perfect hash, every looked-up slot is compared with the digest
asked for, counts are scattered into flat arrays by slot, and the arrays are added up through the array of parent slots
from the deepest level to the top. The shards' partial sums per node are then added. A node or a first turn that very many
conversations share lies in many shards, each with a bounded number of rows. Paths longer than ``BAND`` turns
are cut into bands, worked on from the deepest; the top of a band carries its sums to the band above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.llm.tables import pick
from vaultrail.llm.textbytes import mix
from vaultrail.operators.ordered import int_chunk, number_rows
from vaultrail.session import materialise

#: Path rows that a shard holds on average, turns in a band, positions in a block of a running digest.
SHARD, BAND, BLOCK = 500_000, 100_000, 50_000
#: Member numbers in one piece of a node's list.
LIST = 1 << 16

_SUMS = ["leaves", "saved", "children"]
_EMPTY = hashlib.sha256(b"").hexdigest()


class PerfectHash:
    """Slots 0 to n-1 for n distinct pairs of 64-bit numbers, by levels of hash places that one key has for itself."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        left, given = keys, 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("keys are not distinct")
            size = 2 * len(left) + 1
            at = self._places(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = np.where(alone, np.cumsum(alone) - 1 + given, -1)
            self.levels.append(ranks.astype(np.int32))
            given += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros((given, 2), np.uint64)
        self.keys[self._find(keys)] = keys

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salted = mix(keys[:, 0] + np.uint64((level * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)) ^ keys[:, 1]
        return (mix(salted) % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, ranks in enumerate(self.levels):
            found = ranks[self._places(keys[todo], level, len(ranks))]
            out[todo] = found
            todo = todo[found < 0]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slots of keys; fails unless each slot holds the very key that was asked for."""
        out = self._find(keys)
        if len(out) and ((out < 0).any() or (self.keys[out] != keys).any()):
            raise KeyError("a key that has no slot")
        return out


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))]
    return keys[np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])] if len(keys) else keys


def subtree_sums(own: np.ndarray, parent: np.ndarray, depth: np.ndarray, node: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct digests of a shard, and per digest the sums over its subtree (leaves, saved) and its own children.

    ``own`` and ``parent`` are digests of the rows (pairs of 64-bit numbers); rows of one node may repeat; ``node`` is 1 in the
    one row that counts as the node's own, ``weights`` are what each row adds to its node. Parents that have no row of their
    own are the tops.
    """
    table = PerfectHash(_distinct(np.concatenate([own, parent])))
    n = len(table.keys)
    slot, up = table.slots(own), table.slots(parent)
    above = np.full(n, -1, np.int64)
    above[slot] = up
    level = np.full(n, -1, np.int64)
    level[slot] = depth
    sums = [np.zeros(n, np.int64) for _ in _SUMS]
    for total, weight in zip(sums, weights, strict=True):
        np.add.at(total, slot, weight)
    np.add.at(sums[2], up, node)
    order = np.argsort(-level, kind="stable")
    order = order[level[order] >= 0]
    bounds = np.flatnonzero(np.diff(level[order], prepend=np.int64(-2)))
    for a, b in zip(bounds, [*bounds[1:], len(order)], strict=True):
        rows = order[a:b]
        for total in sums[:2]:
            np.add.at(total, above[rows], total[rows])
    return table.keys, sums


def _counted(table: pa.Table) -> pa.Table:
    """All rows of a shard to one row per node; columns d1, d2, p1, p2, depth, node, leaves, saved, children."""
    column = {n: table.column(n).to_numpy() for n in table.column_names}
    pair = lambda a, b: np.stack([column[a].view(np.uint64), column[b].view(np.uint64)], 1)
    keys, sums = subtree_sums(pair("d1", "d2"), pair("p1", "p2"), column["depth"], column["node"], [column[n] for n in _SUMS])
    return pa.table([*(pa.array(np.ascontiguousarray(keys[:, i]).view(np.int64)) for i in (0, 1)), *(pa.array(s) for s in sums)], names=["d1", "d2", *_SUMS])


def numbered_turns(conversations: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """(conv_id, position from 1, content, n_bytes) of conversations (conv_id, turn, role, text).

    Turns are in ascending order of ``turn``, null first; ties go by role and then by content. Null role or text count as
    empty. ``content`` is a SHA-256 of both, so texts go no further. Rows without conv_id are left out; repeated rows are turns
    of their own; other columns are ignored.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = (F.coalesce(n, F.lit("")) for n in ("role", "text"))
    content = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), content.alias("content"), F.octet_length(text).cast("long").alias("n_bytes"))
    numbered = number_rows(rows, ["conv_id"], ["turn", "role", "content"], [int_chunk("turn")], "position", hot_rows)
    return numbered.select("conv_id", "position", "content", "n_bytes")


def shared_openings(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that begin with the first turns of another one, and all conversations (conv_id, total).

    Conversation c gets the first h turns of conversation c - c % ``group``, h being crc32 of c as text modulo ``most``, and then
    its own turns after its first h. One without turns has a total of 0.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("position").alias("own"))
    sizes = sizes.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    of_base = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    plan = sizes.join(of_base, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    plan = materialise(plan.withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("conv_id", "base", "h", "taken", "total"), "trie-plan")
    heads = turns.where(F.col("position") < most).withColumnRenamed("conv_id", "base")
    first = heads.join(plan.where("taken > 0"), "base").where("position <= h").select("conv_id", "position", "content", "n_bytes")
    later = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").where("position > h")
    later = later.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "content", "n_bytes")
    return first.unionByName(later), plan.select("conv_id", "total")


def _prefixes(turns: DataFrame, members: DataFrame, salt: int, block: int) -> DataFrame:
    """One row per conversation and prefix: conv_id, depth, ends, own and parent digests, last turn."""
    zs = [F.xxhash64(F.lit(2 * salt + i), "position", "content").alias(f"z{i + 1}") for i in (0, 1)]
    rows = turns.select("conv_id", "position", "content", "n_bytes", F.floor((F.col("position") - 1) / block).cast("long").alias("part"), *zs)
    inside = Window.partitionBy("conv_id", "part").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumns({f"d{i}": F.bit_xor(f"z{i}").over(inside) for i in (1, 2)})
    # Blocks after the first of a long conversation begin with the digest of those before.
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    long = members.where(F.col("total") > block).select("conv_id")
    blocks = rows.join(long, "conv_id", "left_semi").groupBy("conv_id", "part").agg(F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"))
    blocks = blocks.select("conv_id", "part", *(F.bit_xor(f"x{i}").over(before).alias(f"b{i}") for i in (1, 2))).where("part > 0")
    run = run.join(blocks, ["conv_id", "part"], "left").join(members, "conv_id")
    own = [F.col(f"d{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)]
    turns_rows = run.select(
        "conv_id", F.col("position").alias("depth"), (F.col("position") == F.col("total")).cast("long").alias("ends"), own[0].alias("d1"), own[1].alias("d2"),
        own[0].bitwiseXOR(F.col("z1")).alias("p1"), own[1].bitwiseXOR(F.col("z2")).alias("p2"), "content", "n_bytes",
    )
    return turns_rows


def _lists(ends: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256): the digest of the conv_ids of each node, in ascending order and joined by commas.

    The lists are written in pieces by tasks that each hold a range of (node, conv_id); a node's pieces then stream through
    one hash, which is sequential by its nature, so a list of any length takes no memory.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2, ids = (batch.column(n).to_numpy() for n in ("d1", "d2", "conv_id"))
            new = np.flatnonzero((np.diff(d1, prepend=0) != 0) | (np.diff(d2, prepend=0) != 0))
            bounds = sorted({0, len(ids), *new.tolist(), *range(0, len(ids), LIST)})
            rows = [(int(d1[a]), int(d2[a]), int(ids[a]), ",".join(map(str, ids[a:b].tolist())).encode()) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(),) * 3 + (pa.binary(),), strict=True)], names=["d1", "d2", "first", "body"]) if rows else pa.RecordBatch.from_pydict({"d1": pa.array([], pa.int64()), "d2": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "body": pa.array([], pa.binary())})

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def row() -> tuple:
            return (*node, state.hexdigest())

        for batch in batches:
            out = []
            for d1, d2, body in zip(*(batch.column(n).to_pylist() for n in ("d1", "d2", "body")), strict=True):
                if (d1, d2) != node:
                    if node:
                        out.append(row())
                    node, state = (d1, d2), hashlib.sha256(body)
                else:
                    state.update(b"," + body)
            yield _digest_batch(out)
        if node:
            yield _digest_batch([row()])

    ordered = ends.repartitionByRange("d1", "d2", "conv_id").sortWithinPartitions("d1", "d2", "conv_id")
    found = ordered.mapInArrow(pieces, "d1 long, d2 long, first long, body binary")
    return found.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first").select("d1", "d2", "body").mapInArrow(digests, "d1 long, d2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["d1", "d2", "ends_sha256"])


def _digested(turns: DataFrame, members: DataFrame, block: int, salts: range) -> tuple[DataFrame, DataFrame]:
    """Stored prefixes and nodes under the first salt without a collision."""
    for salt in salts:
        rows = materialise(_prefixes(turns, members, salt, block), "trie-prefixes")
        same = ["depth", "p1", "p2", "content"]
        nodes = rows.groupBy("d1", "d2").agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("ends").alias("n_ends"), F.max("n_bytes").alias("n_bytes"),
            *(F.min(c).alias(c) for c in same), *(F.max(c).alias(f"_{c}") for c in same),
        )
        sound = (F.col("d1") != 0) | (F.col("d2") != 0)  # which are the root's
        for c in same:
            sound &= F.col(c) == F.col(f"_{c}")
        nodes = materialise(nodes.select("d1", "d2", "p1", "p2", "depth", "n_convs", "conv_id", "n_ends", "n_bytes", (~sound).alias("collided")), "trie-nodes")
        if not nodes.where("collided").limit(1).count():
            return rows, nodes.drop("collided")
    raise ValueError("digests collided under every salt")


def trie_nodes(turns: DataFrame, members: DataFrame, shard: int = SHARD, band: int = BAND, block: int = BLOCK, salts: range = range(4)) -> DataFrame:
    """One row per node of the trie of conversations.

    ``turns`` has (conv_id, position from 1 without gaps, content, n_bytes), ``members`` every conversation once with its number of turns
    (conv_id, total), those without turns too. Columns: d1, d2 (digests), conv_id (smallest member), depth, parent_conv_id
    (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Without any conversation there is no node.
    """
    spark = turns.sparkSession
    rows, nodes = _digested(turns, members, block, salts)
    shape = nodes.agg(F.max("depth"), F.count("*")).first()
    deepest, n_nodes = shape[0] or 0, shape[1]
    owners = nodes.select("conv_id").distinct()
    paths = materialise(rows.select("conv_id", "d1", "d2", "p1", "p2", "depth").join(owners, "conv_id", "left_semi"), "trie-paths")
    shards = max(1, -(-(paths.count() + n_nodes) // shard))
    of_shard = F.pmod(F.xxhash64("conv_id"), F.lit(shards)).alias("shard")
    zero = F.lit(0).cast("long")
    weighted = nodes.select(
        of_shard, "d1", "d2", "p1", "p2", "depth", F.lit(1).cast("long").alias("node"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"), zero.alias("children"),
    )
    plain = paths.select(of_shard, "d1", "d2", "p1", "p2", "depth", zero.alias("node"), *(zero.alias(n) for n in _SUMS))
    everything = plain.unionByName(weighted)
    outputs, carried = [], None
    for k in reversed(range(-(-deepest // band))):
        part = everything.where((F.col("depth") > k * band) & (F.col("depth") <= (k + 1) * band))
        if carried is not None:
            part = part.unionByName(carried)
        found = part.groupBy("shard").applyInArrow(_counted, "d1 long, d2 long, leaves long, saved long, children long")
        sums = materialise(found, "trie-sums").groupBy("d1", "d2").agg(*(F.sum(n).alias(n) for n in _SUMS))
        if k:
            # What the tops of this band gathered goes to their own rows in the band above.
            tops = nodes.where(F.col("depth") == k * band).select(of_shard, "d1", "d2", "p1", "p2", "depth", zero.alias("node"))
            sums = materialise(sums, "trie-band")
            carried = tops.join(sums, ["d1", "d2"]).select("shard", "d1", "d2", "p1", "p2", "depth", "node", *_SUMS)
            sums = sums.join(tops.select("d1", "d2"), ["d1", "d2"], "left_anti")
        outputs.append(sums)
    totals = outputs[0] if outputs else spark.createDataFrame([], "d1 long, d2 long, leaves long, saved long, children long")
    for more in outputs[1:]:
        totals = totals.unionByName(more)
    root = members.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("d1"), zero.alias("d2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("depth"), "n_convs", "conv_id",
    )
    table = materialise(nodes.select("d1", "d2", "p1", "p2", "depth", "n_convs", "conv_id").unionByName(root), "trie-table")
    up = table.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    turnless = members.where("total = 0").select(zero.alias("d1"), zero.alias("d2"), "conv_id")
    lists = _lists(rows.where("ends = 1").select("d1", "d2", "conv_id").unionByName(turnless))
    full = table.join(totals, ["d1", "d2"], "left").join(up, ["p1", "p2"], "left").join(lists, ["d1", "d2"], "left")
    return full.select(
        "d1", "d2", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("children", zero).alias("n_children"),
        # A root without children is itself the leaf.
        F.when((F.col("depth") == 0) & (F.coalesce("children", zero) == 0), F.lit(1).cast("long")).otherwise(F.coalesce("leaves", zero)).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
