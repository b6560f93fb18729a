import random
from collections import Counter

import pytest

from llm import brute
from vaultrail.llm import mixing


def corpus(spark):
    rng = random.Random(3)
    rows = brute.awkward(rng) + [(2000 + i, brute.invented(rng, rng.randint(1, 60)), "en", rng.choice(["b", "a", None, "é", "z"]), 1, 1, "") for i in range(400)]
    return rows, spark.createDataFrame(rows, brute.DOCS)


def test_targets_and_sums(spark):
    rows, frame = corpus(spark)
    found = mixing.taken_copies(frame).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    want = brute.mix_targets(sizes)
    for s, size in sizes.items():
        own = [r for r in found if r.source == s]
        assert {r.source_size for r in own} == {size}
        assert own[0].target == pytest.approx(want[s])
        taken, longest = sum(r.taken for r in own), max(r.size for r in own)
        assert abs(taken - want[s]) <= max(2, min(longest, 0.02 * want[s])), (s, taken, want[s])
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in found)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], len(brute.words(r[1]))) for r in rows)


def test_reruns_agree_and_longer_documents_are_likelier(spark):
    _, frame = corpus(spark)
    first, second = (Counter(tuple(r) for r in mixing.taken_copies(frame).collect()) for _ in range(2))
    assert first == second
    many = spark.createDataFrame([(i, "w " * (5 if i % 2 else 50), "en", "a" if i % 3 else "b", 1, 1, "") for i in range(3000)], brute.DOCS)
    share = Counter()
    for r in mixing.taken_copies(many).collect():
        whole = int(r.target // r.source_size)
        share[r.size] += r.copies - whole
    assert share[50] > 5 * share[5] > 0


def test_mix_repeats_rows(spark):
    rows, frame = corpus(spark)
    copies = Counter()
    for r in mixing.taken_copies(frame).collect():
        copies[r.doc_id, r.source] += r.copies
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +copies


def test_empty_table(spark):
    assert mixing.taken_copies(spark.createDataFrame([], brute.DOCS)).collect() == []


def test_long_documents_neither_end_nor_fill_a_sample(spark):
    rng = random.Random(8)
    lengths = {"a": [1000] + [rng.randint(1, 9) for _ in range(400)], "b": [int(2 ** rng.uniform(0, 11)) for _ in range(300)] + [1] * 5, "c": [rng.randint(1, 9) for _ in range(900)], "d": [3000, 50, 40, 1, 1]}
    rows = [(i, "w " * n, "en", s, 1, 1, "") for i, (s, n) in enumerate((s, n) for s, every in lengths.items() for n in every)]
    frame = spark.createDataFrame(rows, brute.DOCS)
    for weights in ((5, 2, 1), (1, 3, 2, 7), (1, 30, 9, 2)):
        for seed in (sum(weights),):
            found = mixing.taken_copies(frame, weights, seed=seed).collect()
            assert len(found) == len(rows)
            for s in lengths:
                own = [r for r in found if r.source == s]
                target, size = own[0].target, own[0].source_size
                unused = [r.size for r in own if r.copies == int(target / size + 1e-12)]
                # What is missing or too much is at most half of the smallest document that was not used before the closing one.
                off = abs(sum(r.taken for r in own) - target)
                closing = max(r.size for r in own) if s == "d" else min(unused, default=0)
                assert off <= max(1, closing / 2 + 1e-6), (weights, seed, s, off, target)
    # One document of 1000 among 2000 words, of which 600 are wanted: small ones are taken instead.
    small = [(i, "w " * n, "en", "a", 1, 1, "") for i, n in enumerate([1000] + [5] * 200)]
    other = [(5000 + i, "w " * 5, "en", "b", 1, 1, "") for i in range(400)]
    found = [r for r in mixing.taken_copies(spark.createDataFrame(small + other, brute.DOCS), (3, 17)).collect() if r.source == "a"]
    assert sum(r.taken for r in found) == 600 and sum(r.copies for r in found) == 120
