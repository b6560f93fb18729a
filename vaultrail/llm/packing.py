"""Bulk-synchronous best-fit packing of token sequences.

Documents are encoded and cut into pieces of at most the capacity; full pieces are sequences of their own. The other pieces and
the gaps left in sequences are sorted by size, largest first. In each superstep every piece proposes to the smallest gap that
holds it (its successor among the sorted gaps); where several propose to one gap, the largest piece and then the one of
lowest rank wins; the matched gaps shrink, and the losers try again. A piece that no gap holds opens a sequence.

Pieces of one length are interchangeable, so a sorted run of pieces is told completely by its length and ranks, and a run of
gaps by its size and sequence numbers. Spark sorts and ranks the pieces and joins them with what the supersteps
assign to each run of ranks; the supersteps sweep over the runs, of which there are at most as many as the
capacity plus the splits made, whatever the number of documents.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.llm.tables import join_narrow, pick
from vaultrail.llm.tokens import encoder
from vaultrail.session import materialise

#: Parts that the pieces of one length are ranked in, so that a length may have any share of them.
PARTS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, end: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            docs, texts = batch.column("doc_id").cast(pa.int64()).to_pylist(), batch.column("text")
            for begin in range(0, len(docs), 500):
                out: list[list] = [[], [], [], [], [], []]
                for doc, raw in zip(docs[begin : begin + 500], encoder(path).raws(texts.slice(begin, 500).to_pylist()), strict=True):
                    raw += tail
                    for nr, at in enumerate(range(0, len(raw), 4 * capacity)):
                        own = raw[at : at + 4 * capacity]
                        for column, value in zip(out, (doc, nr, at // 4, len(own) // 4, zlib.crc32(own), np.frombuffer(own, "<u4").astype(np.int32) if with_ids else None), strict=True):
                            column.append(value)
                arrays = [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())), strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(arrays[: 5 + with_ids], names=names[: 5 + with_ids])

    return run


def pieces(documents: DataFrame, path: str, end: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and ids on request. A null text is empty: only ``end``."""
    return pick(documents, "doc_id", "text").mapInArrow(_pieces(path, end, capacity, with_ids), PIECES + (", ids array<int>" if with_ids else ""))


def supersteps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first sequence, offset) that place all pieces shorter than ``capacity``.

    ``counts`` has the number of pieces by length; ranks of a length start at 0, sequences at 0.
    """
    left = {length: n for length, n in counts.items() if n and length < capacity}
    done: dict[int, int] = defaultdict(int)
    gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    runs: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, done[length], n, sequence, offset))
        done[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]
        if capacity - offset - length:
            fresh[capacity - offset - length].append((sequence, n))

    while left:
        # Sweep both sorted lists once: the lengths and, for each, its successor among the gaps.
        proposals: dict[int, list[int]] = defaultdict(list)
        sizes, at = sorted(gaps), 0
        for length in sorted(left):
            while at < len(sizes) and sizes[at] < length:
                at += 1
            if at < len(sizes):
                proposals[sizes[at]].append(length)
        fresh: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
        if proposals:
            for size, lengths in proposals.items():
                for length in sorted(lengths, reverse=True):
                    while length in left and gaps[size]:
                        sequence, n = gaps[size].popleft()
                        take = min(n, left[length])
                        if take < n:
                            gaps[size].appendleft((sequence + take, n - take))
                        place(length, take, sequence, capacity - size)
                if not gaps[size]:
                    del gaps[size]
        largest = max(left, default=0)
        if largest and not any(size >= largest for size in gaps) and not any(size >= largest for size in fresh):
            # The largest pieces fit nowhere: those over half the capacity never share, others fill sequences side by side.
            side = max(1, capacity // largest)
            bins = -(-left[largest] // side)
            sequence, opened = opened, opened + bins
            rows = [bins] * (left[largest] // bins) + ([left[largest] % bins] if left[largest] % bins else [])
            for k, n in enumerate(rows):
                place(largest, n, sequence, k * largest)
            # Only the last piece in a sequence tells its gap.
            for size in {capacity - (k + 1) * largest for k in range(len(rows))}:
                fresh[size] = deque(x for x in fresh[size] if not sequence <= x[0] < sequence + bins)
            if len(rows) > 1 and rows[-1] < bins:
                short = capacity - (len(rows) - 1) * largest
                fresh[short].append((sequence + rows[-1], bins - rows[-1]))
            last = capacity - len(rows) * largest
            if last:
                fresh[last].append((sequence, rows[-1]))
        for size, more in fresh.items():
            if more:
                gaps[size].extend(more)
    return runs


def place(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to stored pieces (doc_id, piece, length, ...).

    Reruns agree up to the exchange of equal rows. Sequences are full pieces first, numbered from 0, then the packed ones.
    """
    spark = parts.sparkSession
    salted = parts.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    sums = materialise(sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-sums")
    counts = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = counts.get(capacity, 0)
    runs = supersteps(counts, capacity)
    plan = spark.createDataFrame([(*r[:3], r[3] + full, r[4]) for r in runs] + ([(capacity, 0, full, 0, 0)] if full else []), "length long, low long, n long, sequence long, offset long")
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("nr", F.row_number().over(own))
    ranked = join_narrow(ranked, sums.drop("n"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("nr") - 1)
    at = plan.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("low", "n", "sequence", "offset"))).alias("runs"))
    found = join_narrow(ranked, at, "length").withColumn("run", F.expr("filter(runs, r -> r.low <= rank and rank < r.low + r.n)[0]"))
    return found.select(*parts.columns, (F.col("run.sequence") + F.col("rank") - F.col("run.low")).alias("sequence_id"), F.col("run.offset").alias("offset"))


def pack(documents: DataFrame, path: str, end: int = 0, capacity: int = 2048) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row is packed, repeated ones and those without doc_id too; a null or empty text is a piece with the id
    ``end`` alone; other columns are ignored; an empty table gives an empty result.
    """
    return place(materialise(pieces(documents, path, end, capacity), "pack-pieces"), capacity)


def sequences(documents: DataFrame, path: str, end: int = 0, capacity: int = 2048) -> DataFrame:
    """The packed sequences: sequence_id and all ids in it, at most ``capacity``."""
    stored = materialise(pieces(documents, path, end, capacity, with_ids=True), "pack-ids")
    placed = place(stored, capacity)
    both = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return both.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
