"""Bi-temporal vector memory: versions, as-of state and exact similarity search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.operators.ordered import neighbour

# Change log words.
UPSERT, DELETE = "upsert", "delete"
DEFAULT_REASON = "soft_delete"

# Rows of a block of documents and of a block of queries in an exact search, on average.
DOC_BLOCK = 8192
QUERY_BLOCK = 1024


def versions(changes: DataFrame, chunk: list[Column]) -> DataFrame:
    """Validity intervals from an append-only change log ``(id, op, ts, reason, ...)``, ``ts`` in milliseconds.

    Each upsert opens a version; the next change of the id closes it. ``valid_to`` is null for the open version and
    ``closed_by`` tells how a version ended. Stamps given in ``given_from`` and ``given_to`` columns win, if present.
    """
    following = F.struct("ts", "op", "reason")
    seen = neighbour(changes, ["id"], ["ts", "op"], chunk, following, "_next", 1)
    opened = seen.where(F.col("op") == UPSERT)
    given = {c: F.col(c) if c in changes.columns else F.lit(None).cast("bigint") for c in ("given_from", "given_to")}
    ended = F.when(F.col("_next.op") == DELETE, F.coalesce("_next.reason", F.lit(DEFAULT_REASON))).when(
        F.col("_next.op") == UPSERT, "superseded"
    )
    return opened.withColumns(
        {
            "valid_from": F.coalesce(given["given_from"], F.col("ts")),
            "valid_to": F.coalesce(given["given_to"], F.col("_next.ts")),
            "closed_by": ended,
        }
    ).drop("_next", "op", "reason", "ts", *[c for c in given if c in changes.columns])


def as_of(valid_from: Column | str, valid_to: Column | str, at: Column) -> Column:
    """Whether a version is valid at a time; combined with any other filter by AND."""
    valid_from = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    valid_to = F.col(valid_to) if isinstance(valid_to, str) else valid_to
    return (valid_from <= at) & ((valid_to > at) | valid_to.isNull())


def state_at(memory: DataFrame, at: Column | int | None = None) -> DataFrame:
    """Versions valid at a time in milliseconds, by default now."""
    if at is None:
        at = F.unix_millis(F.current_timestamp())
    elif isinstance(at, int):
        at = F.lit(at)
    return memory.where(as_of("valid_from", "valid_to", at))


def _unit(matrix):
    length = np.linalg.norm(matrix, axis=-1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _usable(vector: Column) -> Column:
    """Whether a vector is given and holds finite numbers only."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))


def _best(k: int):
    """The ``k`` best of a block of documents for each vector of a block of queries; ties go to the smaller id."""

    def search(docs, asked):
        import pandas as pd

        found = [[], [], []]
        docs = docs.sort_values("id", kind="stable")
        of_docs, of_asked = docs["vector"].map(len).to_numpy(), asked["vector"].map(len).to_numpy()
        for size in np.unique(of_asked):
            near, names = docs[of_docs == size], asked["query_id"].to_numpy()[of_asked == size]
            if near.empty:
                continue
            ids = near["id"].to_numpy()
            left, right = (_unit(np.stack(v.to_numpy()).astype(np.float64)) for v in (asked["vector"][of_asked == size], near["vector"]))
            for name, vector, scores in zip(names, left, left @ right.T, strict=True):
                keep = np.arange(len(ids))
                if len(ids) > k:
                    keep = np.flatnonzero(scores >= np.partition(scores, len(ids) - k)[len(ids) - k] - 1e-9)
                # Equal vectors get equal scores here, which a product of matrices does not promise.
                exact = (right[keep] * vector).sum(axis=1)
                first = np.argsort(-exact, kind="stable")[:k]
                found[0] += [name] * len(first)
                found[1] += list(ids[keep[first]])
                found[2] += exact[first].tolist()
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), found)))

    return search


def top_k(memory: DataFrame, queries: DataFrame, k: int, vector: str = "values", query_vector: str = "query") -> DataFrame:
    """The ``k`` most similar documents of each query vector by cosine similarity, exactly.

    Documents and queries ``(query_id, query)`` are divided into blocks by their ids, and each two blocks meet in one task,
    which keeps ``k`` documents per query; only these are ranked. Ties go to the smaller id. A vector that is null or holds
    a null or non-finite number takes no part, one of length zero scores 0, and only vectors of equal size are compared.
    """
    docs = memory.select("id", F.col(vector).alias("vector")).where(_usable(F.col("vector")))
    asked = queries.select("query_id", F.col(query_vector).alias("vector")).where(_usable(F.col("vector")))

    def blocks(rows: DataFrame, size: int) -> int:
        return max(1, -(-rows.count() // size))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    across, down = blocks(memory, DOC_BLOCK), blocks(queries, QUERY_BLOCK)
    docs = docs.withColumn("_d", F.pmod(F.xxhash64("id"), F.lit(across)).cast("int")).withColumn("_q", every(down))
    asked = asked.withColumn("_q", F.pmod(F.xxhash64("query_id"), F.lit(down)).cast("int")).withColumn("_d", every(across))
    types = dict(asked.dtypes) | dict(docs.dtypes)
    met = docs.groupBy("_d", "_q").cogroup(asked.groupBy("_d", "_q"))
    partial = met.applyInPandas(_best(k), f"query_id {types['query_id']}, id {types['id']}, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return partial.withColumn("rank", F.row_number().over(ranked).cast("bigint")).where(F.col("rank") <= k)


def top_k_one(memory: DataFrame, query: list[float], k: int, vector: str = "values") -> DataFrame:
    """The ``k`` most similar documents of one vector, with built-in expressions."""
    q = F.array(*[F.lit(float(x)) for x in query])
    v = F.transform(vector, lambda x: x.cast("double"))

    def total(column: Column) -> Column:
        return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)

    dot = total(F.zip_with(v, q, lambda a, b: a * b))
    length = F.sqrt(total(F.transform(v, lambda x: x * x))) * F.lit(float(np.linalg.norm(np.array(query, dtype=np.float64))))
    scored = memory.withColumn("score", F.when(length > 0, dot / length).otherwise(0.0))
    return scored.orderBy(F.desc("score"), F.asc("id")).limit(k)
