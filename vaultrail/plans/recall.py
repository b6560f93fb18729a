"""Vector memory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultrail.functions.numbers import floor_div
from vaultrail.operators import memory
from vaultrail.plans import inputs
from vaultrail.plans.oracle import MEMORY, with_
from vaultrail.plans.registry import registrar

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)

AS_OF = 700_000


def versions(spark, folder):
    return memory.versions(inputs.memory_changes(spark, folder), [floor_div("ts", 100_000)])


@query(with_(MEMORY) + "SELECT id, valid_from, valid_to, closed_by, label FROM versions")
def memory_versions(spark, folder):
    return versions(spark, folder).select("id", "valid_from", "valid_to", "closed_by", "label")


@query(
    with_(MEMORY)
    + f"""SELECT id, valid_from, label FROM versions WHERE valid_from <= {AS_OF} AND (valid_to > {AS_OF} OR valid_to IS NULL) AND (label = 3 OR label = 7)"""
)
def memory_asof(spark, folder):
    """State at a time, together with a filter of the caller's own."""
    state = memory.state_at(versions(spark, folder), AS_OF)
    return state.where((F.col("label") == 3) | (F.col("label") == 7)).select("id", "valid_from", "label")


@query(
    with_(
        MEMORY,
        f"state AS (SELECT id, values_::DOUBLE[] AS v FROM versions WHERE valid_from <= {AS_OF} AND (valid_to > {AS_OF} OR valid_to IS NULL))",
        "asked AS (SELECT label AS query_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label))",
    )
    + """SELECT query_id, id, round(list_cosine_similarity(v, q), 4) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY list_cosine_similarity(v, q) DESC, id) AS rank FROM state, asked) WHERE rank <= 10"""
)
def memory_topk_asof(spark, folder):
    """The ten most similar memories of one vector per label, as of a time."""
    state = memory.state_at(versions(spark, folder), AS_OF)
    base = inputs.table(spark, folder, "embeddings")
    asked = base.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("query"))
    found = memory.top_k(state, asked, 10)
    return found.select("query_id", "id", F.round("score", 4).alias("score"), "rank")


@query(
    with_(
        MEMORY,
        f"state AS (SELECT id, values_::DOUBLE[] AS v FROM versions WHERE valid_from <= {AS_OF} AND (valid_to > {AS_OF} OR valid_to IS NULL))",
        "asked AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 100 = 0)",
    )
    + """SELECT query_id, id, round(list_cosine_similarity(v, q), 4) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY list_cosine_similarity(v, q) DESC, id) AS rank FROM state, asked) WHERE rank <= 10"""
)
def memory_search_one(spark, folder):
    """The memories most similar to each single vector whose id is divisible by 100, as of a time."""
    asked = inputs.table(spark, folder, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    found = memory.top_k(memory.state_at(versions(spark, folder), AS_OF), asked, 10)
    return found.select("query_id", "id", F.round("score", 4).alias("score"))
