import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from harness import compare, connect
from vaultrail.llm import hard_negatives as hn
from vaultrail.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, leaf int, score string, rank int, query_id long"


def vectors(rng, n=500, width=10, spread=0.5):
    centres = rng.normal(0, 1, (6, width))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(0, spread, width)], int(rng.integers(0, 4)), 1, "clash", 0, 1) for i in range(n)]
    odd = [(n, None, 1), (n + 1, [], 1), (n + 2, [None, 1.0], 1), (n + 3, [math.nan] * width, 1), (n + 4, [math.inf] * width, 1), (n + 5, [0.0] * width, 1), (None, [1.0] * width, 1), (n + 6, [1.0, 2.0], 1), (n + 7, [1.0] * width, None)]
    same = [(n + 10 + k, rows[0][1], k % 3) for k in range(200)]
    return rows + [(i, v, label, None, None, None, None) for i, v, label in odd + same]


def brute(rows, step, n_positives, k, low, high):
    kept = [(i, np.floor(256 * np.float32(v).astype(float)).tolist(), label) for i, v, label, *_ in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v, _ in kept)
    kept = [(i, np.array(v + [0.0] * (width - len(v))), label) for i, v, label in kept]
    out = []
    for a, x, label in kept:
        if a % step == 0:
            scored = sorted((-int(x @ y), i, lab) for i, y, lab in kept if i != a)
            for s, p, _ in [r for r in scored if r[2] == label][:n_positives]:
                fits = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:k]
                out += [(a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread, sizes", [(0.5, {"leaf": 40, "block": 16, "sample": 100}), (0.05, {"leaf": 20, "block": 8}), (3.0, {})])
def test_negatives_are_those_of_brute_force(spark, spread, sizes):
    rows = vectors(np.random.default_rng(0), spread=spread)
    found = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, F.col("label"), k=7, **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 20, 5, 7, 30, 90)


def test_other_windows(spark):
    rows = vectors(np.random.default_rng(1), 200)
    found = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, F.col("label"), n_positives=2, k=1000, low=-50, high=100, leaf=30, block=10)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 10, 2, 1000, -50, 100)


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 1, 0, "", 0, 0), (5, [1.0, 1.0], 1, 0, "", 0, 0), (7, [0.5, 2.0], 2, 0, "", 0, 0)], SCHEMA)
    found = [tuple(r) for r in hn.hard_negatives(frame, F.col("vec_id") == 0, F.col("label")).collect()]
    assert found == [(0, 5, 1, 7, 65536, 32768)]
    for few in (frame.limit(0), frame.where("vec_id = 0"), frame.where("vec_id > 0"), frame.where("label = 1")):
        assert hn.hard_negatives(few, F.col("vec_id") == 0, F.col("label")).collect() == []
    # A repeated anchor asks once.
    assert hn.hard_negatives(frame.unionByName(frame.where("vec_id = 0")), F.col("vec_id") == 0, F.col("label")).count() == 1


def test_ranges_bound_distances_and_eliminate():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(c, 0.3, (200, 6)) for c in rng.normal(0, 5, (8, 6))])
    length = float(np.sqrt(np.square(rows).sum(1).max()))
    tree = hn.plant(rows, length, 4)
    lifted = tree.lifted(rows)
    assert np.allclose(np.linalg.norm(lifted, axis=1), length)
    leaves = tree.leaf(lifted)
    away = tree.distances(lifted, leaves)
    low, high = np.full((16, 8), np.inf), np.full((16, 8), np.inf)
    for leaf in np.unique(leaves):
        low[leaf], high[leaf] = away[leaves == leaf].min(0), away[leaves == leaf].max(0)
    full = hn.Tree(tree.top, tree.below, length, low, high)
    anchors = np.concatenate([rows[::50], np.zeros((32, 1))], 1)
    near, far = full.reach(anchors)
    real = hn._distance(anchors, lifted)
    for q in range(len(anchors)):
        assert (real[q] >= near[q, leaves] - 1e-6).all() and (real[q] <= far[q, leaves] + 1e-6).all()
    # Leaves that can't hold a row as near as the nearest one are most of them.
    assert (near > real.min(1)[:, None] * 1.01 + 1e-6).mean() > 0.5


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(connect(folder), QUERIES["op11_hard_negatives"](spark, folder), ORACLES["op11_hard_negatives"]) is None
