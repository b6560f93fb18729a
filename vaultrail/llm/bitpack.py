"""Token ids in fixed-width bits, in blocks that can be read one by one.

A folder holds two tables. ``blocks`` has one row per block of whole documents: shard, its number in the shard (block), the
place of its first id in the shard (first), the bits per id (width), the ids packed end to end, most significant bit first
(payload), and per document its doc_id and number of ids. ``shards`` has the number of ids of each shard. Shards follow each
other in ascending doc_id, so the place of a document's ids among all ids is known without reading any payload.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultrail.llm.tables import join_narrow, pick
from vaultrail.llm.tokens import CHARACTERS, TOGETHER, encoder

#: Ids after which a block ends, with the document that reaches it.
BLOCK = 1 << 16
BLOCKS = "shard int, block int, first long, n_ids long, width int, payload binary, doc_ids array<long>, lengths array<int>"


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width == 16:
        return ids.astype(">u2").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    return np.packbits(bits.reshape(-1)).tobytes()


def unpack(payload: bytes, width: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` on; only the bytes that hold them are looked at."""
    if width == 16:
        return np.frombuffer(payload, ">u2", count, 2 * first).astype(np.uint32)
    begin, end = first * width, (first + count) * width
    raw = np.frombuffer(payload, np.uint8, -(-end // 8) - begin // 8, begin // 8)
    bits = np.unpackbits(raw)[begin % 8 : begin % 8 + count * width].reshape(count, width)
    full = np.zeros((count, 32), np.uint8)
    full[:, 32 - width :] = bits
    return np.packbits(full, axis=1).view(">u4").reshape(-1).astype(np.uint32)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of as many rows as are encoded together, or of fewer and a few megabytes."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        for begin in range(0, len(batch), TOGETHER):
            held.append(batch.slice(begin, TOGETHER))
            rows += len(held[-1])
            size += held[-1].nbytes
            if rows >= TOGETHER or size >= CHARACTERS:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _blocks(path: str, end: int, width: int):
    """Encode the documents of a partition in their order. A shard is a partition of the range sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        docs: list[int | None] = []
        lengths: list[int] = []
        tail = np.array([end], "<u4").tobytes()
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32()))])

        def close() -> pa.RecordBatch:
            nonlocal block, first, ids, docs, lengths
            packed = np.frombuffer(b"".join(ids), "<u4")
            row = pa.RecordBatch.from_pylist([{"shard": shard, "block": block, "first": first, "n_ids": len(packed), "width": width, "payload": pack(packed, width), "doc_ids": docs, "lengths": lengths}], schema=schema)
            block, first = block + 1, first + len(packed)
            ids, docs, lengths = [], [], []
            return row

        held = 0
        for part in _together(batches):
            for doc, raw in zip(part.column("doc_id").to_pylist(), encoder(path).raws(part.column("text").to_pylist()), strict=True):
                ids += (raw, tail)
                docs.append(doc)
                lengths.append(len(raw) // 4 + 1)
                held += lengths[-1]
                if held >= BLOCK:
                    yield close()
                    held = 0
        if docs:
            yield close()

    return run


def write_ids(documents: DataFrame, folder: str, path: str, end: int, vocabulary: int) -> None:
    """Write the ids of all texts, each followed by ``end``, in ascending doc_id to ``folder``.

    A null text is empty: its only id is ``end``. Rows without doc_id come first; rows with the same doc_id follow each
    other in the order of a hash of their texts. An empty table gives a folder without blocks. Other columns are ignored.
    """
    ordered = pick(documents, "doc_id", "text").withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(_blocks(path, end, width_of(vocabulary)), BLOCKS).write.parquet(f"{folder}/blocks")
    blocks = documents.sparkSession.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).write.parquet(f"{folder}/shards")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["width"], 0, row["n_ids"])
            ends = np.cumsum(row["lengths"])
            begins = ends - row["lengths"]
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array([row["shard"]] * len(crc), pa.int32()), pa.array(begins + row["first"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "shard", "place", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = spark.read.schema("shard int, n_ids long").parquet(f"{folder}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    found = blocks.mapInArrow(_documents, "doc_id long, shard int, place long, n_tokens long, ids_crc32 long")
    return join_narrow(found, shards, "shard").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, folder: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start`` among all ids; reads the blocks that hold them and nothing else."""
    shards = spark.read.schema("shard int, n_ids long").parquet(f"{folder}/shards").orderBy("shard").collect()
    out, base = [], 0
    for shard in shards:
        low, high = max(start - base, 0), min(start + count - base, shard["n_ids"])
        if low < high:
            rows = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").where((F.col("shard") == shard["shard"]) & (F.col("first") < high) & (F.col("first") + F.col("n_ids") > low))
            for row in rows.select("first", "n_ids", "width", "payload").orderBy("first").collect():
                a, b = max(low - row["first"], 0), min(high - row["first"], row["n_ids"])
                out.append(unpack(row["payload"], row["width"], a, b - a))
        base += shard["n_ids"]
    return np.concatenate(out) if out else np.empty(0, np.uint32)
