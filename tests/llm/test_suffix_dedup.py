import hashlib
import random

import numpy as np
import pytest

from llm import brute
from vaultrail.llm import suffix_dedup


def check(spark, rows, size, key, **more):
    frame = spark.createDataFrame(rows, brute.DOCS)
    found = suffix_dedup.removed_spans(frame, size, key, **more).collect()
    want = []
    for r, gone in zip(rows, brute.removed([r[1] for r in rows], size), strict=True):
        raw = (r[1] or "").encode()
        kept = bytes(b for i, b in enumerate(raw) if i not in gone)
        spans = sum(i - 1 not in gone for i in gone)
        want.append((r[0], len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_against_all_strings(spark, hot):
    check(spark, brute.awkward(random.Random(2)), 200, 48, hot=hot)


@pytest.mark.parametrize("seed", range(3))
def test_many_overlaps(spark, seed):
    rng = random.Random(seed)
    pool = [brute.invented(rng, 25) for _ in range(6)]
    rows = [(i, " ".join(rng.choice(pool)[rng.randint(0, 30) :] for _ in range(rng.randint(0, 4))), None, None, None, None, None) for i in range(30)]
    check(spark, rows, 200, 48)


def test_split_bucket_with_colliding_fingerprints(spark):
    """Segments of one large bucket, all fingerprints equal: only suffixes with equal bytes repeat."""

    class OneValue:
        """Fingerprints that all collide."""

        def __init__(self, data):
            self.n = len(data)

        def all_of(self, size):
            return np.zeros(self.n - size + 1, np.uint64)

    rng = random.Random(5)
    key = brute.invented(rng, 9)[:48].ljust(48, "k")
    shared = "".join(rng.choice("abcdef") for _ in range(120))
    texts = ["".join(rng.choice("abcdef") for _ in range(150)) + key + (shared if i % 2 else "") + "".join(rng.choice("abcdef") for _ in range(200)) for i in range(12)]
    texts += [texts[1][:60] + texts[1][60:320] + "z" * 30]
    frame = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    for prints in (suffix_dedup.Fingerprints, OneValue):
        spans = suffix_dedup.repeated_spans(frame, 200, 48, hot=1, print_of=prints).collect()
        got = {r["key"]: {i for a, b in suffix_dedup.merged(r["spans"]) for i in range(a, b)} for r in spans}
        want = {i: set(gone) for i, gone in enumerate(brute.removed(texts, 200)) if gone}
        assert got == want


def test_cover_reaches_every_pair():
    d = set(suffix_dedup.COVER)
    assert {(a - b) % suffix_dedup.PERIOD for a in d for b in d} == set(range(suffix_dedup.PERIOD))


def test_anchors_are_first_minima():
    rng = np.random.default_rng(0)
    for text in (rng.integers(97, 100, 900).astype(np.uint8), np.full(700, 97, np.uint8), np.tile(np.arange(97, 107, dtype=np.uint8), 70)):
        from vaultrail.llm.textbytes import Fingerprints

        hashed = Fingerprints(text).all_of(48) >> np.uint64(8)
        want = [i + int(np.argmin(hashed[i : i + 153])) for i in range(len(text) - 199)]
        assert suffix_dedup.anchors(text).tolist() == want


def test_texts_stay_whole_characters(spark):
    rows = brute.awkward(random.Random(2))
    out = suffix_dedup.deduplicated(spark.createDataFrame(rows, brute.DOCS))
    assert out.columns == spark.createDataFrame(rows, brute.DOCS).columns
    kept = out.collect()
    assert len(kept) == len(rows) and all(r.n_chars == len(r.text or "") for r in kept)


def test_empty_table(spark):
    assert suffix_dedup.removed_spans(spark.createDataFrame([], brute.DOCS)).collect() == []
