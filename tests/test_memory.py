import random

import numpy as np
from pyspark.sql import functions as F

from vaultrail.functions.numbers import floor_div
from vaultrail.operators import memory

SCHEMA = "id bigint, op string, ts bigint, reason string, values array<float>"


def test_versions_equal_fold(spark):
    rng = random.Random(5)
    times = rng.sample(range(10_000), 300)
    log = [(0 if rng.random() < 0.5 else rng.randrange(20), "delete" if rng.random() < 0.3 else "upsert", t, rng.choice([None, "why"]), None) for t in times]
    frame = spark.createDataFrame(log, SCHEMA)
    expected = []
    for key in {r[0] for r in log}:
        mine = sorted((r for r in log if r[0] == key), key=lambda r: r[2])
        for now, later in zip(mine, mine[1:] + [None]):
            if now[1] == "upsert":
                end = None if later is None else "superseded" if later[1] == "upsert" else later[3] or "soft_delete"
                expected.append((key, now[2], later[2] if later else None, end))
    for width in (50, 3000, 1_000_000):
        found = memory.versions(frame, [floor_div("ts", width)])
        assert sorted((r.id, r.valid_from, r.valid_to, r.closed_by) for r in found.collect()) == sorted(expected)
    at = 5000
    alive = [e for e in expected if e[1] <= at and (e[2] is None or e[2] > at)]
    assert memory.state_at(found, at).count() == len(alive)
    assert memory.state_at(found).count() == sum(e[2] is None for e in expected)


def test_given_stamps_win(spark):
    frame = spark.createDataFrame([(1, "upsert", 10, None, None, 5, None), (1, "delete", 20, None, None, None, None), (2, "upsert", 10, None, None, None, 15)], SCHEMA + ", given_from bigint, given_to bigint")
    found = {r.id: (r.valid_from, r.valid_to) for r in memory.versions(frame, [floor_div("ts", 100)]).collect()}
    assert found == {1: (5, 20), 2: (10, 15)}


def test_top_k_equals_numpy(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(300, 8)).astype(np.float32)
    vectors[7] = 0
    vectors[20] = vectors[21]
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, values array<float>").repartition(5)
    queries = spark.createDataFrame([("a", [float(x) for x in vectors[20]]), ("b", [float(x) for x in rng.normal(size=8)])], "query_id string, query array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        found = memory.top_k(docs, queries, 12).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for row in queries.collect():
        q = np.array(row.query)
        norm = np.linalg.norm(vectors.astype(float), axis=1) * np.linalg.norm(q)
        score = np.divide(vectors.astype(float) @ q, norm, out=np.zeros(300), where=norm > 0)
        best = sorted(range(300), key=lambda i: (-round(score[i], 12), i))[:12]
        mine = sorted((r for r in found if r.query_id == row.query_id), key=lambda r: r.rank)
        assert [r.id for r in mine] == best and np.allclose([r.score for r in mine], score[best])
        one = memory.top_k_one(docs, list(q), 12).collect()
        assert [r.id for r in one] == best and np.allclose([r.score for r in one], score[best])


def test_many_queries_and_bad_vectors(spark):
    docs = spark.createDataFrame(
        [(1, [1.0]), (2, None), (3, [None]), (4, [float("nan")]), (5, [2.0]), (6, [1.0, 1.0])], "id bigint, values array<double>"
    )
    queries = spark.range(4097).select(F.col("id").alias("query_id"), F.array(F.lit(1.0)).alias("query"))
    bad = spark.createDataFrame([(-1, None), (-2, [None]), (-3, [1.0, 2.0, 3.0])], "query_id bigint, query array<double>")
    found = memory.top_k(docs, queries.unionByName(bad), 1)
    assert found.agg(F.count("*"), F.countDistinct("query_id"), F.min("id"), F.max("id"), F.max("rank")).first() == (4097, 4097, 1, 1, 1)
    assert memory.top_k(docs, queries.where("false"), 1).count() == 0
    assert memory.top_k(docs.where("false"), bad, 1).count() == 0


def test_blocks_meet(spark, monkeypatch):
    monkeypatch.setattr(memory, "DOC_BLOCK", 7)
    monkeypatch.setattr(memory, "QUERY_BLOCK", 2)
    test_top_k_equals_numpy(spark)
