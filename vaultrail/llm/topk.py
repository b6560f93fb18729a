"""Exact top-k by inner product over vectors sorted by length.

Vectors are put in descending order of length and cut into blocks. Coordinates are rotated by the singular vectors of all
vectors, so the first ones carry most of every inner product. The blocks of the longest vectors are scored first
and give each query a k-th best score so far. For every other block, a query is dropped if its length times the block's
greatest length cannot reach that score; for the queries left, partial sums over the leading rotated coordinates plus
the product of the residual lengths (Cauchy-Schwarz) bound the score, and vectors below it are not computed in full.
Scores themselves are computed on the original whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultrail.llm.blocks import BLOCK, best, matrix, packed, search, top_rows
from vaultrail.session import materialise

#: Query vectors in a block; coordinates of a partial sum.
QUERIES, STEP = 1024, 16
#: Whole numbers up to this sum exactly as doubles.
EXACT = float(1 << 53)


def _gram(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width)), 0
        for batch in batches:
            data = matrix(batch.column("vector"), width)
            total, n = total + data.T @ data, n + len(data)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.reshape(-1))], names=["cell", "value"])

    return run


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first, from the sum of their outer products."""
    cells = vectors.select("vector").mapInArrow(_gram(width), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    gram = np.zeros(width * width)
    gram[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    values, axes = np.linalg.eigh(gram.reshape(width, width))
    return axes[:, np.argsort(-values, kind="stable")]


def _dot(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as doubles below 2**53 or else as Python's long integers would round."""
    if len(queries) and len(data) and np.abs(queries).sum(1).max() * np.abs(data).max() < EXACT:
        return queries @ data.T
    return (queries.astype(np.longdouble) @ data.astype(np.longdouble).T).astype(np.float64)


def _solver(k: int, axes: np.ndarray, step: int = STEP):
    def solve(qid: np.ndarray, queries: np.ndarray, extra: dict, ids: np.ndarray, data: np.ndarray):
        least = np.frombuffer(extra["least"])
        length = np.linalg.norm(queries, axis=1)
        reach = np.linalg.norm(data, axis=1)
        # A little slack, since bounds are rounded and scores equal to the k-th may win by their id.
        slack = 1e-6 * (1 + np.abs(least))
        live = length * reach.max(initial=0.0) >= least - slack
        if not live.any() or not len(ids):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        qid, queries, least, slack = qid[live], queries[live], least[live], slack[live]
        turned, other = queries @ axes, data @ axes
        possible = np.ones((len(qid), len(ids)), bool)
        if np.isfinite(least).any():
            partial = np.zeros(possible.shape)
            for at in range(0, axes.shape[1] - step, step):
                partial += turned[:, at : at + step] @ other[:, at : at + step].T
                rest = np.linalg.norm(turned[:, at + step :], axis=1)[:, None] * np.linalg.norm(other[:, at + step :], axis=1)[None, :]
                possible &= partial + rest >= (least - slack)[:, None]
                keep = possible.any(0)
                if not keep.all():
                    partial, possible, other, data, ids = partial[:, keep], possible[:, keep], other[keep], data[keep], ids[keep]
        q, v, s = top_rows(np.where(possible, _dot(queries, data), -np.inf), qid, ids, k)
        return q, v, s.astype(np.int64)

    return solve


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_name: str = "vec_id", vector_name: str = "embedding", scale: float = 64.0, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query with all other rows.

    Components are ``floor(scale * x)`` of x as a double. Rows whose vector is null, empty or has null or infinite
    components or none that are numbers take no part, nor do rows without id. Rows of the query's own id are no candidates. Where lengths differ,
    missing components count as 0. Ties go to the smaller vec_id; rows that repeat an id count once each.
    Fewer candidates than ``k`` give fewer rows; no query or no candidate gives none. Other columns are ignored.
    """
    from vaultrail.llm.blocks import sound

    named = vectors.select(vectors[id_name].cast("long").alias("vec_id"), vectors[vector_name].alias("vector"), is_query.alias("asked"))
    named = named.where(F.col("vec_id").isNotNull() & sound(F.col("vector")))
    whole = named.withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double")))
    whole = whole.withColumn("square", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    whole = materialise(whole, "topk-vectors")
    shape = whole.agg(F.max(F.size("vector")), F.count("*")).first()
    if not shape[1]:
        return best(vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long"), k)
    width = shape[0]
    axes = rotation(whole, width)
    zero = F.lit(0).alias("part")
    ordered = whole.repartitionByRange(F.desc("square"), F.asc("vec_id")).sortWithinPartitions(F.desc("square"), F.asc("vec_id"))
    stored = materialise(packed(ordered.select(zero, "vec_id", "vector"), width, block).withColumn("top", _greatest(width)("data")), "topk-blocks")
    asked = whole.where("asked").select(zero, "vec_id", "vector").repartition(F.ceil(F.col("vec_id") / QUERIES))
    queries = materialise(packed(asked, width, QUERIES), "topk-queries")
    # The blocks of the longest vectors, enough to hold k candidates for any query.
    ranked = stored.groupBy("top").agg(F.sum(F.length("ids") / 8).alias("n")).orderBy(F.desc("top")).limit(64).collect()
    seen, edge = 0, 0.0
    for row in ranked:
        seen, edge = seen + row["n"], row["top"]
        if seen > 2 * k:
            break
    unknown = queries.withColumn("least", _floor(None)("ids"))
    first = materialise(search(unknown, stored.where(F.col("top") >= edge), width, k, _solver(k, axes), "long"), "topk-first")
    kth = first.where(F.col("rank") == k).select("query_id", "score")
    least = kth.select((F.col("query_id")).alias("vec_id"), "score")
    asked = whole.where("asked").select("vec_id").distinct().join(least, "vec_id", "left")
    bounds = queries.withColumn("id", F.explode(_ids()("ids"))).join(asked, F.col("id") == F.col("vec_id"), "left").groupBy("ids").agg(F.collect_set(F.struct("id", "score")).alias("known"))
    bounded = queries.join(bounds, "ids").withColumn("least", _floor("known")("ids", "known")).drop("known")
    rest = search(bounded, stored.where(F.col("top") < edge), width, k, _solver(k, axes), "long")
    return best(first.drop("rank").unionByName(rest.drop("rank")), k)


def _greatest(width: int):
    return F.pandas_udf(lambda data: data.map(lambda x: float(np.square(np.frombuffer(x).reshape(-1, width)).sum(1).max())), "double")


def _ids():
    return F.pandas_udf(lambda ids: ids.map(lambda x: np.frombuffer(x, np.int64)), "array<long>")


def _floor(known: str | None):
    """Lowest score that still matters, by query of a block; minus infinity where k are not found yet."""
    if known is None:
        return F.pandas_udf(lambda ids: ids.map(lambda x: np.full(len(x) // 8, -np.inf).tobytes()), "binary")

    def of(ids, scores):
        def one(raw, pairs):
            by = {p["id"]: p["score"] for p in pairs if p["score"] is not None}
            return np.array([by.get(i, -np.inf) for i in np.frombuffer(raw, np.int64).tolist()], float).tobytes()

        return ids.combine(scores, one)

    return F.pandas_udf(of, "binary")
