"""Vectors in blocks, and searches of query blocks in vector blocks.

A block is a row with up to ``BLOCK`` vectors packed as bytes. Blocks of queries meet blocks of vectors by an equi-join on
the partition that both are for, so a partition of any size spreads over its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2048
FOUND = "query_id long, vec_id long, score {}"


def sound(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles; a shorter vector is filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def packed(rows: DataFrame, width: int, size: int = BLOCK) -> DataFrame:
    """Blocks (part, ids, data) of rows (part, vec_id, vector) in the order they come, by part."""
    schema = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def close(part: int) -> pa.RecordBatch:
            ids, data = (np.concatenate(x) for x in zip(*held.pop(part), strict=True))
            return pa.RecordBatch.from_pylist([{"part": part, "ids": ids.tobytes(), "data": data.tobytes()}], schema=schema)

        for batch in batches:
            parts, ids, data = batch.column("part").to_numpy(), batch.column("vec_id").to_numpy(), matrix(batch.column("vector"), width)
            for part in np.unique(parts).tolist():
                at = np.flatnonzero(parts == part)
                while len(at):
                    room = size - sum(len(x[0]) for x in held.get(part, ()))
                    held.setdefault(part, []).append((ids[at[:room]], data[at[:room]]))
                    if len(at) >= room:
                        yield close(part)
                    at = at[room:]
        for part in list(held):
            yield close(part)

    return rows.select("part", "vec_id", "vector").mapInArrow(run, "part int, ids binary, data binary")


def search(queries: DataFrame, vectors: DataFrame, width: int, k: int, solve: Callable, kind: str) -> DataFrame:
    """The ``k`` best (query_id, vec_id, score) of each query over all pairs of blocks of the same part.

    ``solve(query ids, query matrix, extra, ids, matrix)`` gives arrays of query ids, vector ids and scores, at most ``k`` a query.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qid, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                extra = {n: row[n] for n in row if n not in ("q_ids", "q_data", "ids", "data", "part")}
                found = solve(qid, np.frombuffer(row["q_data"]).reshape(-1, width), extra, ids, np.frombuffer(row["data"]).reshape(-1, width))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    met = queries.withColumnsRenamed({"ids": "q_ids", "data": "q_data"}).join(vectors, "part")
    # Every pair of blocks is work for itself, wherever the join put it.
    return best(met.repartition(F.xxhash64("q_ids", "ids")).mapInArrow(run, FOUND.format(kind)), k)


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of each query, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_rows(scores: np.ndarray, qid: np.ndarray, ids: np.ndarray, k: int):
    """The ``k`` best columns of each row by (score, smaller id), never the row's own id; -inf is no score."""
    scores = np.where(qid[:, None] == ids[None, :], -np.inf, scores)
    order = np.argsort(ids, kind="stable")
    scores, ids = scores[:, order], ids[order]
    if len(ids) > k:
        edge = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
        above = scores >= edge[:, None]
    else:
        above = np.ones(scores.shape, bool)
    q, v = np.nonzero(above & (scores > -np.inf))
    rank = np.lexsort((v, -scores[q, v], q))
    q, v = q[rank], v[rank]
    nth = np.arange(len(q)) - np.searchsorted(q, q, "left")
    keep = nth < k
    return qid[q[keep]], ids[v[keep]], scores[q[keep], v[keep]]
