import random

import numpy as np
import pytest

from llm import brute
from vaultrail.llm import ngram_join, tables
from vaultrail.llm.textbytes import words


def expected(rows, size, percent):
    sets = {}
    for r in rows:
        sets.setdefault(r[0], []).append(brute.ngrams(r[1], size))
    ids = [i for i in sets if i is not None]
    edges = [(a, b) for a in ids for b in ids if a < b for x in sets[a] for y in sets[b] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    return brute.components(ids, edges), sets


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_against_all_pairs(spark, size, percent):
    rng = random.Random(4)
    rows = brute.awkward(rng)
    for k in range(30):
        w = brute.invented(rng, 80).split()
        for j in range(rng.randint(1, 4)):
            own = list(w)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = "edit"
            rows.append((1000 + 10 * k + j, " ".join(own), "en", "s", 1, 1, "x"))
    # Different texts under one doc_id, and the same set twice.
    rows += [(1000, rows[-1][1], None, None, None, None, None), (1000, rows[-1][1] + " ", None, None, None, None, None), (4000, rows[30][1], None, None, None, None, None), (4000, rows[31][1], None, None, None, None, None)]
    found = ngram_join.similarity_components(spark.createDataFrame(rows, brute.DOCS), size, percent).collect()
    want, sets = expected(rows, size, percent)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id], r
            assert r.n_ngrams in {len(s) for s in sets[r.doc_id]}
    # Without a doc_id: the component of equal texts, or null.
    assert {(r.n_ngrams > 0, r.component_id) for r in found if r.doc_id is None} == {(True, want[6]), (False, None)}


def test_parts_of_large_groups(spark, monkeypatch):
    rng = random.Random(1)
    base = brute.invented(rng, 60).split()
    rows = [(i, " ".join([*base[:-1], f"w{i}"]), None, None, None, None, None) for i in range(50)]
    monkeypatch.setattr(ngram_join, "PART", 6)
    found = ngram_join.similarity_components(spark.createDataFrame(rows, brute.DOCS), 3, 90).collect()
    assert {r.component_id for r in found} == {0}


def test_empty_table(spark):
    assert ngram_join.similarity_components(spark.createDataFrame([], brute.DOCS)).collect() == []


def test_trie_finds_all_links():
    rng = np.random.default_rng(0)
    for _ in range(40):
        sets = []
        for _ in range(rng.integers(2, 12)):
            base = np.arange(rng.integers(1, 5), 25)
            sets.append(np.unique(np.where(rng.random(len(base)) < 0.08, rng.integers(30, 60, len(base)), base)))
        sizes = np.array([len(s) + rng.integers(0, 2) for s in sets])
        edges = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * (i := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (sizes[a] + sizes[b] - i)]
        forest = ngram_join.links(sets, sizes, 80)
        assert brute.components(range(len(sets)), forest) == brute.components(range(len(sets)), edges)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    found = {r.node: r.component for r in tables.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_words_by_bytes():
    texts = ["a b\x0bc", "", "\x1cx é\x85y ", "  "]
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, row = words(data, bounds)
    assert [(int(r), bytes(data[s:e])) for s, e, r in zip(starts, ends, row, strict=True)] == [(i, w) for i, t in enumerate(texts) for w in brute.words(t)]
