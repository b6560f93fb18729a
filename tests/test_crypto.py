import base64
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from vaultrail.functions import crypto
from vaultrail.functions.crypto import Keyring

VALUES = ["alice@example.com", "bob@example.com", "", "日本語", "😀 smile", "x" * 300]


def expected(ring, key_id, value):
    key = hashlib.sha256(ring.keys[key_id].encode()).digest()
    return hmac.new(key, value.encode(), hashlib.sha256).hexdigest()


def test_blind_index_is_hmac(spark, ring):
    rows = ring.attach(spark.createDataFrame([(v,) for v in VALUES], "v string"))
    found = {r.v: r.i for r in rows.select("v", crypto.blind_index("v", F.col("_key")).alias("i")).collect()}
    assert found == {v: expected(ring, "v2", v) for v in VALUES}


def test_indexes_under_every_key(spark, ring):
    rows = ring.attach_all(spark.createDataFrame([("usr_alice",), (None,)], "v string"))
    found = {r.v: r.i for r in rows.select("v", crypto.blind_indexes("v", F.col("_keys")).alias("i")).collect()}
    assert found["usr_alice"] == [expected(ring, k, "usr_alice") for k in ring.ids] == ring.tokens("usr_alice")
    assert found[None] is None


def sealed(spark, ring, rows):
    frame = ring.attach(spark.createDataFrame(rows, "id bigint, t string"))
    return frame.select("id", "t", crypto.seal(F.col("t"), F.col("id"), F.col("_key")).alias("s"), crypto.sealed_length(F.col("t"), F.col("_key")).alias("n"))


def test_seal_round_trip_layout_and_length(spark, ring):
    texts = ["", "{}", "é" * 10, "x" * 5000]
    frame = sealed(spark, ring, list(enumerate(texts)))
    opened = ring.attach_data_keys(frame).withColumn("o", crypto.open_sealed("s", F.col("_data_keys")))
    for r in opened.collect():
        assert r.o == r.t
        assert len(r.s) == r.n and "\n" not in r.s
        key_id, body = r.s.split(":")
        assert key_id == "v2" and len(base64.b64decode(body)) == 12 + len(r.t.encode()) + 16


def test_seal_differs_by_row_and_is_stable_on_retry(spark, ring):
    frame = sealed(spark, ring, [(1, "same"), (2, "same")])
    first, second = [r.s for r in frame.collect()], [r.s for r in frame.collect()]
    assert first[0] != first[1] and first == second


def test_wrong_or_unknown_key_opens_to_null(spark, ring):
    frame = sealed(spark, ring, [(1, "secret")])
    other = Keyring({"v2": "another"}, "v2").attach_data_keys(frame)
    assert other.select(crypto.open_sealed("s", F.col("_data_keys")).alias("o")).first().o is None
    none = Keyring({"v9": "k-two"}, "v9").attach_data_keys(frame)
    assert none.select(crypto.open_sealed("s", F.col("_data_keys")).alias("o")).first().o is None


def test_old_rows_stay_readable_after_rotation(spark):
    old = Keyring.single("k-one")
    assert old.active_id == "v1"
    frame = sealed(spark, old, [(1, "kept")])
    new = Keyring({"v1": "k-one", "v2": "k-two"}, "v2").attach_data_keys(frame)
    assert new.select(crypto.open_sealed("s", F.col("_data_keys")).alias("o")).first().o == "kept"


def test_keyring_rules(spark):
    with pytest.raises(ValueError):
        Keyring({f"v{i}": "k" for i in range(6)}, "v1")
    with pytest.raises(ValueError):
        Keyring({"v1": "k"}, "v2")
    with pytest.raises(ValueError):
        Keyring({}, "v1")
    table = spark.createDataFrame([("v1", "a", False), ("v2", "b", True)], "key_id string, raw_key string, active boolean")
    assert Keyring.from_table(table) == Keyring({"v1": "a", "v2": "b"}, "v2")
    with pytest.raises(ValueError):
        Keyring.from_table(table.withColumn("active", F.lit(True)))


def test_keys_do_not_show_in_plans(spark, ring):
    frame = sealed(spark, ring, [(1, "x")])
    plan = frame._jdf.queryExecution().toString()
    for key_id, raw in ring.keys.items():
        assert raw not in plan and ring.data_key(key_id).hex() not in plan.lower()
