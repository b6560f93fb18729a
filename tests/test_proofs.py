import hashlib
import json
import random

from pyspark.sql import functions as F

from vaultrail.functions.metadata import canonical_json
from vaultrail.operators import proofs
from vaultrail.sources import ledger as store


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_merkle_paths(spark):
    payload, rng = '{"a":1}', random.Random(1)

    def proof(steps):
        path = [sha(f"s{i}") for i in range(steps)]
        h = sha(payload)
        for s in path:
            h = sha(h + s) if rng.random() < 0.5 else sha(s + h)
        return h, json.dumps(path)

    rows, expected = [], {}
    for steps in (0, 1, 2, 5, 10, 11, 14):
        root, path = proof(steps)
        rows += [(f"ok{steps}", payload, root, path), (f"tampered{steps}", payload + " ", root, path)]
        expected |= {f"ok{steps}": True, f"tampered{steps}": False}
    for name, path in {"broken": "{not json", "object": '{"a":1}', "null": None, "word": '"x"', "nested": '["a",["b"]]'}.items():
        rows.append((name, payload, sha(payload), path))
        expected[name] = False
    frame = spark.createDataFrame(rows, "id string, payload string, merkle_root string, merkle_path_json string")
    assert {r.id: r.valid for r in proofs.verify_proofs(frame).collect()} == expected


def test_merkle_paths_with_positions(spark):
    rows, expected = [], {}
    for steps, at in ((0, 0), (3, 5), (12, 2049), (20, 777_777), (44, 2**43 + 11)):
        path, h = [sha(f"s{i}") for i in range(steps)], sha("p")
        for i, s in enumerate(path):
            h = sha(s + h) if at >> i & 1 else sha(h + s)
        rows += [(f"ok{steps}", "p", h, json.dumps(path), at), (f"elsewhere{steps}", "p", h, json.dumps(path), at ^ 1)]
        expected |= {f"ok{steps}": True, f"elsewhere{steps}": steps == 0}
    rows += [("unsided", "p", rows[-2][2], rows[-2][3], None), ("broken", "p", "x", "{", 1), ("no path", "p", "x", None, 1)]
    expected |= {"unsided": None, "broken": False, "no path": False}
    frame = spark.createDataFrame(rows, "id string, payload string, merkle_root string, merkle_path_json string, at bigint")
    assert {r.id: r.valid for r in proofs.verify_proofs(frame, position="at").collect()} == expected


def ledger(spark, sizes):
    rows = [(p, i, sha(f"{p}{i}")) for p, n in sizes.items() for i in range(1, n + 1)]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "project_id string, seq bigint, payload_hash string").repartition(3)


def fold(hashes):
    out = ["0" * 64]
    for h in hashes:
        out.append(sha(out[-1] + h))
    return out[1:]


def test_chain_and_anchors_equal_fold(spark):
    sizes, block = {"a": 70, "b": 4, "c": 1}, 4
    chain = proofs.build_chain(ledger(spark, sizes), block_size=block)
    anchors = proofs.build_anchors(chain, block).collect()
    found = {(r.project_id, r.seq): r.chain_hash for r in chain.collect()}
    for p, n in sizes.items():
        values = fold([sha(f"{p}{i}") for i in range(1, n + 1)])
        assert [found[p, i] for i in range(1, n + 1)] == values
        heads = [values[min(i + block, len(values)) - 1] for i in range(0, len(values), block)]
        here = sorted((r.pos, r.hash, r.chain) for r in anchors if r.project_id == p)
        assert here == list(zip(range(len(heads)), heads, fold(heads)))


def test_appends_continue_the_chain(spark, tmp_path):
    path = str(tmp_path)
    store.append_chain(ledger(spark, {"a": 5, "b": 2}), path, 0)
    # Done again, with entries that are chained already, after one that died before its heads were written.
    ledger(spark, {"a": 9}).selectExpr("project_id", "seq", "payload_hash", "payload_hash AS chain_hash").write.parquet(f"{path}/links/commit=1")
    for _ in range(2):
        heads = {r.project_id: r.seq for r in store.append_chain(ledger(spark, {"a": 12, "c": 3}), path, 1).collect()}
        assert heads == {"a": 12, "c": 3}
    store.append_chain(ledger(spark, {"a": 12, "b": 2, "c": 3}), path, 2)
    chain = store.read_chain(spark, path)
    found = {(r.project_id, r.seq): r.chain_hash for r in chain.collect()}
    assert chain.count() == len(found) == 17
    for p, n in {"a": 12, "b": 2, "c": 3}.items():
        assert [found[p, i] for i in range(1, n + 1)] == fold([sha(f"{p}{i}") for i in range(1, n + 1)])
    assert [r.broken for r in proofs.check_chain(chain, 4).collect()] == [0, 0, 0]


def test_breaks_are_found(spark):
    chain = proofs.build_chain(ledger(spark, {"a": 20, "b": 20, "c": 20, "d": 20}), block_size=8)
    changed = chain.withColumn("payload_hash", F.when(F.expr("project_id = 'a' AND seq = 11"), F.lit("x")).otherwise(F.col("payload_hash")))
    changed = changed.withColumn("chain_hash", F.when(F.expr("project_id = 'b' AND seq = 5"), F.lit("y")).otherwise(F.col("chain_hash")))
    changed = changed.where("NOT (project_id = 'c' AND seq = 3)")
    found = {r.project_id: (r.entries, r.first_broken, r.broken) for r in proofs.check_chain(changed, 8).collect()}
    assert found == {"a": (20, 11, 1), "b": (20, 5, 2), "c": (19, 4, 1), "d": (20, None, 0)}


def test_attestation_digest(spark):
    events = spark.createDataFrame([(1, "pay", "acc", '{"b":1,"a":"x"}'), (2, "pay", "", None)], "event_id int, action string, target string, metadata string")

    def digest(challenge, text):
        return hashlib.sha256(challenge.encode() + b":" + hashlib.sha256(text.encode()).digest()).hexdigest()

    good = digest("c1", '{"action":"pay","metadata":{"a":"x","b":1},"target":"acc"}')
    other = digest("c2", '{"action":"pay","metadata":null,"target":null}')
    challenges = spark.createDataFrame([(1, "c1", good), (2, "c2", other)], "event_id int, challenge string, digest string")
    rows = proofs.check_attestations(events, challenges, canonical_json("metadata")).collect()
    assert len(rows) == 2 and all(r.matches for r in rows)
