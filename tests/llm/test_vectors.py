import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultrail.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def vectors(rng, n=400, width=12):
    centres = rng.normal(0, 1, (8, width))
    rows = [(i, [float(x) for x in centres[i % 8] + rng.normal(0, 0.4, width)], 1, "clash", 0) for i in range(n)]
    odd = [(n, None), (n + 1, []), (n + 2, [None, 1.0]), (n + 3, [math.nan] * width), (n + 4, [math.inf] * width), (n + 5, [0.0] * width), (None, [1.0] * width), (n + 6, [1.0, 2.0])]
    same = [(n + 10 + k, rows[0][1]) for k in range(30)]
    repeated = [(1, rows[1][1]), (2, rows[9][1])]
    return rows + [(i, v, None, None, None) for i, v in odd + same + repeated]


def taking_part(rows, zero):
    kept = [(i, np.float32(v).astype(float).tolist()) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]
    width = max(len(v) for _, v in kept)
    return [(i, np.array(v + [0.0] * (width - len(v)))) for i, v in kept]


@pytest.mark.parametrize("k", [3, 20, 1000])
def test_top_k_is_exact(spark, k):
    rows = vectors(np.random.default_rng(0))
    frame = spark.createDataFrame(rows, SCHEMA)
    found = topk.exact_top_k(frame, F.col("vec_id") % 20 == 0, k=k, block=64).collect()
    kept = [(i, np.floor(64 * v)) for i, v in taking_part(rows, True)]
    for q, x in kept:
        if q % 20 == 0:
            want = sorted(((-int(x @ y), i) for i, y in kept if i != q))[:k]
            got = [(-r.score, r.vec_id) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)]
            assert got == want, q


def test_top_k_prunes():
    rng = np.random.default_rng(1)
    data, queries = np.floor(64 * rng.normal(0, 1, (500, 16))), np.floor(64 * rng.normal(0, 1, (5, 16)))
    axes = np.linalg.eigh(data.T @ data)[1][:, ::-1]
    scores = queries @ data.T
    least = np.sort(scores, axis=1)[:, -3].copy()
    q, v, s = topk._solver(3, axes, 4)(np.arange(5) + 1000, queries, {"least": least.tobytes()}, np.arange(500), data)
    assert sorted(zip(q - 1000, v, strict=True)) == sorted((i, j) for i in range(5) for j in np.argsort(-scores[i])[:3])


def test_nearest_recall_and_scores(spark):
    rows = vectors(np.random.default_rng(3), 3000, 16)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = ann.nearest(frame, F.col("vec_id") % 50 == 0, k=5).collect()
    kept = taking_part(rows, False)
    by = {i: v for i, v in kept}
    hits = total = 0
    for q in {i for i, _ in kept if i % 50 == 0}:
        x = by[q]
        want = {i for _, i in sorted((-round(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), 12), i) for i, y in kept if i != q)[:5]}
        got = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in got] == [1, 2, 3, 4, 5]
        assert [(-round(r.score, 12), r.vec_id) for r in got] == sorted((-round(r.score, 12), r.vec_id) for r in got)
        hits, total = hits + len(want & {r.vec_id for r in got}), total + 5
        for r in got:
            assert r.score == pytest.approx(max(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)) for i, y in kept if i == r.vec_id), abs=1e-12)
    assert hits / total >= 0.9


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 1, "", 0), (50, [1.0, 1.0], 1, "", 0), (7, [2.0, 2.0], 1, "", 0)], SCHEMA)
    found = [(r.query_id, r.rank, r.vec_id) for r in ann.nearest(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    for empty in (frame.limit(0), frame.where("vec_id = 7")):
        assert ann.nearest(empty, F.col("vec_id") % 50 == 0).collect() == []
        assert topk.exact_top_k(empty, F.col("vec_id") % 20 == 0).collect() == []


def test_parts_are_balanced():
    rng, data = random.Random(0), ann.unit(np.random.default_rng(0).normal(0, 1, (600, 8)))
    own = ann.balanced_parts(data, ann.neighbours(data, 10), 6)
    assert max(np.bincount(own)) <= math.ceil(1.1 * 600 / 6) and rng
