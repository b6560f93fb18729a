"""Approximate nearest neighbours by cosine with learned partitions.

On a bounded sample: the graph of nearest neighbours is divided into balanced parts, first by balanced centroids, then by moving vertices to the
part where most of their neighbours are as long as parts stay balanced. A small neural network learns, for a vector, the
parts of its neighbours. It then puts every vector of the table into its most probable part and sends each query to several
most probable ones, in which exact cosines decide. The number of parts to ask is the smallest that finds ``TARGET`` of
the neighbours within the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultrail.llm.blocks import best, matrix, packed, search, sound
from vaultrail.session import materialise

#: Vectors the model is fitted on at most; parts; hidden units; neighbours in the graph; queries in a block.
SAMPLE, PARTS, HIDDEN, GRAPH, QUERIES = 4000, 16, 64, 10, 1024
TARGET = 0.97


def unit(data: np.ndarray) -> np.ndarray:
    return data / np.sqrt(np.square(data).sum(1, keepdims=True))


def neighbours(data: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` nearest other rows, by cosine of unit rows."""
    out = []
    for at in range(0, len(data), 500):
        scores = data[at : at + 500] @ data.T
        scores[np.arange(len(scores)), at + np.arange(len(scores))] = -np.inf
        part = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        out.append(np.take_along_axis(part, np.argsort(-np.take_along_axis(scores, part, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def balanced_parts(data: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.1) -> np.ndarray:
    """Part of each row: balanced centroids, then moves along the graph within the capacity."""
    room = int(np.ceil(slack * len(data) / parts))
    centres = data[np.linspace(0, len(data) - 1, parts).astype(int)]
    own = np.zeros(len(data), int)
    for _ in range(10):
        scores = data @ centres.T
        filled = np.zeros(parts, int)
        for i in np.argsort(-scores.max(1), kind="stable"):
            for p in np.argsort(-scores[i], kind="stable"):
                if filled[p] < room:
                    own[i] = p
                    filled[p] += 1
                    break
        sums = np.zeros_like(centres)
        np.add.at(sums, own, data)
        centres = unit(sums + 1e-12)
    filled = np.bincount(own, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for i in range(len(data)):
            votes = np.bincount(own[graph[i]], minlength=parts)
            p = int(np.argmax(votes))
            if votes[p] > votes[own[i]] and filled[p] < room:
                filled[own[i]] -= 1
                filled[p] += 1
                own[i] = p
                moved += 1
        if not moved:
            break
    return own


@dataclass
class Router:
    """Two-layer network from unit vectors to parts, and the number of parts a query asks."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def scores(self, data: np.ndarray) -> np.ndarray:
        return np.maximum(data @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, data: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        return np.argsort(-self.scores(data), axis=1, kind="stable")


def train(data: np.ndarray, aim: np.ndarray, hidden: int, rounds: int = 250, rate: float = 0.01) -> Router:
    """Cross-entropy between the network's parts and ``aim``, each row's distribution of neighbours' parts."""
    rng = np.random.default_rng(0)
    weights = [rng.normal(0, np.sqrt(2 / data.shape[1]), (data.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, aim.shape[1])), np.zeros(aim.shape[1])]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        inner = np.maximum(data @ weights[0] + weights[1], 0)
        odds = inner @ weights[2] + weights[3]
        share = np.exp(odds - odds.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        d_odds = (share - aim) / len(data)
        d_inner = (d_odds @ weights[2].T) * (inner > 0)
        for i, g in enumerate((data.T @ d_inner, d_inner.sum(0), inner.T @ d_odds, d_odds.sum(0))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            weights[i] = weights[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
    return Router(*weights)


def fit(data: np.ndarray, k: int, parts: int = PARTS, target: float = TARGET) -> Router:
    """Learn from the rows of ``data``. Equal rows count once; few rows make one part."""
    data = unit(np.unique(data, axis=0))
    parts = max(1, min(parts, len(data) // (4 * GRAPH)))
    if parts == 1:
        return Router(np.zeros((data.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbours(data, GRAPH)
    own = balanced_parts(data, graph, parts)
    aim = np.zeros((len(data), parts))
    np.add.at(aim, (np.repeat(np.arange(len(data)), GRAPH), own[graph].reshape(-1)), 1 / GRAPH)
    np.add.at(aim, (np.arange(len(data)), own), 1.0)
    router = train(data, aim / aim.sum(1, keepdims=True), HIDDEN)
    order = router.parts(data)
    home = order[:, 0]
    place = np.argsort(order, axis=1)
    # Number of parts a row must ask until it meets each of its nearest neighbours.
    asked = np.sort(place[np.repeat(np.arange(len(data)), min(k, GRAPH)), home[graph[:, :k]].reshape(-1)])
    router.probes = int(asked[int(np.ceil(target * len(asked))) - 1]) + 1
    return router


def _routed(router: Router, width: int, many: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = router.parts(unit(matrix(batch.column("vector"), width)))[:, :many].astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, parts.size + 1, parts.shape[1], dtype=np.int32), pa.array(parts.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), lists], names=["vec_id", "vector", "parts"])

    return run


def _nearest(k: int):
    def solve(qid: np.ndarray, queries: np.ndarray, extra: dict, ids: np.ndarray, data: np.ndarray):
        # Equal vectors are scored once, so their scores are equal to the last bit.
        distinct, inverse = np.unique(data, axis=0, return_inverse=True)
        order = np.lexsort((ids, inverse.reshape(-1)))
        group = inverse.reshape(-1)[order]
        keep = np.arange(len(group)) - np.searchsorted(group, group, "left") <= k
        column, ids = group[keep], ids[order][keep]
        scores = (unit(queries) @ unit(distinct).T)[:, column]
        scores[qid[:, None] == ids[None, :]] = -np.inf
        take = min(k, len(ids))
        # Round off what differs by the order of summation, then settle the scores row by row.
        rounded = np.round(scores, 13)
        edge = np.partition(rounded, len(ids) - take, axis=1)[:, len(ids) - take]
        q, v = np.nonzero((rounded >= edge[:, None]) & (scores > -np.inf))
        rank = np.lexsort((ids[v], -rounded[q, v], q))
        q, v = q[rank], v[rank]
        near = np.arange(len(q)) - np.searchsorted(q, q, "left") < take
        q, v = q[near], v[near]
        a, b = queries[q], distinct[column[v]]
        exact = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
        return qid[q], ids[v], exact

    return solve


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_name: str = "vec_id", vector_name: str = "embedding", parts: int = PARTS, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): ``k`` near neighbours of each query by cosine, in double precision.

    Vectors that are null, empty or zero or have null or infinite components or none that are numbers take no part,
    nor do rows without id. Rows of the query's own id are no candidates. Where lengths differ, missing components count as 0.
    Ties go to the smaller vec_id. The model is fitted on at most ``sample`` vectors, chosen by a hash of their ids; all
    vectors are in the index. Other columns are ignored; an empty table gives an empty result.
    """
    named = vectors.select(vectors[id_name].cast("long").alias("vec_id"), vectors[vector_name].alias("vector"), is_query.alias("asked"))
    named = named.where(F.col("vec_id").isNotNull() & sound(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    named = materialise(named.withColumn("vector", F.transform("vector", lambda x: x.cast("double"))), "ann-vectors")
    shape = named.agg(F.max(F.size("vector")), F.count("*")).first()
    if not shape[1]:
        return best(vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score double"), k)
    width = shape[0]
    chosen = named.select("vector", F.xxhash64("vec_id").alias("h")).orderBy("h").limit(sample).select("vector").toArrow()
    router = fit(matrix(chosen.column("vector").combine_chunks(), width), k, parts, target)
    schema = "vec_id long, vector array<double>, parts array<int>"
    index = named.select("vec_id", "vector").mapInArrow(_routed(router, width, 1), schema).select(F.col("parts")[0].alias("part"), "vec_id", "vector")
    asked = named.where("asked").select("vec_id", "vector").mapInArrow(_routed(router, width, router.probes), schema).select(F.explode("parts").alias("part"), "vec_id", "vector")
    stored = materialise(packed(index, width), "ann-blocks")
    queries = materialise(packed(asked.repartition("part", F.ceil(F.col("vec_id") / (50 * QUERIES))), width, QUERIES), "ann-queries")
    return search(queries, stored, width, k, _nearest(k), "double")
