import random

from pyspark.sql import functions as F

from vaultrail.operators.ordered import int_chunk, logical_clock, neighbour, number_rows


def rows(seed=7, n=600):
    """Three scopes, one of which holds most rows; ids are sparse and shuffled."""
    rng = random.Random(seed)
    out = [(rng.choice(["hot", "hot", "hot", "b", "c"]), i * 3 + 1, rng.choice([None, None, rng.randrange(900)])) for i in range(n)]
    rng.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "scope string, id bigint, incoming bigint").repartition(5)


def by_scope(data):
    scopes = {}
    for scope, i, v in sorted(data, key=lambda r: r[1]):
        scopes.setdefault(scope, []).append((i, v))
    return scopes


def test_numbers(spark):
    data = rows()
    found = number_rows(frame(spark, data), ["scope"], ["id"], [int_chunk("id", 50)], hot_rows=100).collect()
    expected = {i: n for items in by_scope(data).values() for n, (i, _) in enumerate(items, 1)}
    assert {r.id: r.position for r in found} == expected and len(found) == len(data)


def test_neighbours_keep_null_values(spark):
    data = rows()
    for step in (-1, 1):
        found = neighbour(frame(spark, data), ["scope"], ["id"], [int_chunk("id", 40)], F.struct("incoming"), "near", step, hot_rows=150).collect()
        expected = {}
        for items in by_scope(data).values():
            for n, (i, _) in enumerate(items):
                at = n + step
                expected[i] = (items[at][1],) if 0 <= at < len(items) else None
        assert {r.id: tuple(r.near) if r.near else None for r in found} == expected


def test_logical_clock_equals_fold(spark):
    data = rows()
    base = {"hot": 50, "b": 0, "c": 7}
    given = F.when(F.col("scope") == "hot", 50).when(F.col("scope") == "c", 7)
    for width, hot in [(10, 0), (64, 200), (64, 10_000), (100_000, 0)]:
        found = logical_clock(
            frame(spark, data), ["scope"], ["id"], [int_chunk("id", width)], F.col("incoming"), given, hot_rows=hot
        ).collect()
        expected = {}
        for scope, items in by_scope(data).items():
            clock = base[scope]
            for i, incoming in items:
                clock = max(clock, incoming or 0) + 1
                expected[i] = clock
        assert {r.id: r.logical_clock for r in found} == expected


def test_negative_order_values(spark):
    data = [("a", i, None) for i in range(-25, 25)]
    found = number_rows(frame(spark, data), ["scope"], ["id"], [int_chunk("id", 10)], hot_rows=5).collect()
    assert all(r.position == r.id + 26 for r in found)


def test_a_hot_key_is_spread_over_its_chunks(spark):
    """Also after a join by the key alone, whose partitioning a window over (key, chunk) could otherwise reuse."""
    left, right = frame(spark, rows()), spark.createDataFrame([("hot", 1)], "scope string, x int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "scope", "left")
        found = number_rows(joined, ["scope"], ["id"], [int_chunk("id", 50)])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = [line for line in plan.splitlines() if "hashpartitioning(scope" in line and "_chunk0" in line]
    assert windows, plan


def test_null_keys_are_kept(spark):
    data = [(None, 1, None), ("a", 2, None)]
    found = number_rows(frame(spark, data), ["scope"], ["id"], [int_chunk("id", 10)], hot_rows=0).collect()
    assert {(r.scope, r.position) for r in found} == {(None, None), ("a", 1)}
