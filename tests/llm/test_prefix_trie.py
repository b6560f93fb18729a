import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harness import compare, connect
from vaultrail.llm import prefix_trie
from vaultrail.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, d1 string, shard long, content string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            content = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, role, content), (role, text)))
    turns = {c: [x for _, x in sorted(t)] for c, t in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = {k: [v for v in members if v[: len(k)] == k] for k in members}
    children = {k: sum(len(v) == len(k) + 1 for v in below[k]) for k in members}
    rows = []
    for k, own in members.items():
        saved = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in below[k] if v)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(k))))
        up = min(members[k[:-1]]) if k else None
        rows.append((min(own), len(k), up, len(own), children[k], sum(not children[v] for v in below[k]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def found(frame, **sizes):
    turns, members = prefix_trie.shared_openings(prefix_trie.numbered_turns(frame, sizes.pop("hot_rows", 1_000_000)))
    return sorted((tuple(r) for r in prefix_trie.trie_nodes(turns, members, **sizes).select(COLUMNS).collect()), key=repr)


def conversations(rng):
    rows = []
    for c in [*range(0, 60), 102, 103, 2**40]:
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "ho", "é", ""]), 1, "clash", 2, "x"))
    # Copies, a long conversation, nulls everywhere, ties, repeated rows and rows without conversation.
    rows += [(c, t, "user", f"same {t}", None, None, None, None) for c in range(200, 230) for t in range(6)]
    rows += [(300, t, "user", "go on", None, None, None, None) for t in range(300)] + [(305, t, "user", "go on", None, None, None, None) for t in range(280)]
    rows += [(400, None, None, None, None, None, None, None), (400, None, "a", None, None, None, None, None), (400, 1, None, "x", None, None, None, None), (None, 1, "user", "lost", None, None, None, None)]
    rows += [(401, 2, "b", "tie", 0, "", 0, ""), (401, 2, "a", "tie", 0, "", 0, ""), (401, 2, "a", "tie", 0, "", 0, ""), (401, 1, "z", "y" * 50_000, 0, "", 0, "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard": 50, "band": 40, "block": 7, "hot_rows": 20}])
def test_nodes_are_those_of_brute_force(spark, sizes):
    rows = conversations(random.Random(0))
    assert found(spark.createDataFrame(rows, SCHEMA), **sizes) == brute(rebuilt(rows))


def test_few_rows(spark):
    frame = spark.createDataFrame([(7, 0, "user", "a", 0, "", 0, "")], SCHEMA)
    assert found(frame.limit(0)) == []
    # crc32("7") % 9 turns of its own are left out, and there is no conversation 5 to begin with.
    assert found(frame) == brute(rebuilt([(7, 0, "user", "a")]))
    assert found(spark.createDataFrame([(None, 0, "user", "a", 0, "", 0, "")], SCHEMA)) == []


def test_collisions_are_found_and_salted_away(spark, monkeypatch):
    rows = conversations(random.Random(1))
    salts, real = [], F.xxhash64

    def weak(*columns):
        # Under the first salt the digests of a turn tell only its position.
        salt = columns[0] if not isinstance(columns[0], str) else None
        if salt is not None and len(salts) < 2:
            salts.append(salt)
            return real(salt, columns[1])
        return real(*columns)

    monkeypatch.setattr(prefix_trie.F, "xxhash64", weak)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rebuilt(rows))
    assert len(salts) == 2


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(0)
    keys = prefix_trie._distinct(rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64))
    table = prefix_trie.PerfectHash(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(KeyError):
        table.slots(keys + np.uint64(1))
    assert len(prefix_trie.PerfectHash(keys[:0]).slots(keys[:0])) == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(connect(folder), QUERIES["op12_prefix_trie"](spark, folder), ORACLES["op12_prefix_trie"]) is None
