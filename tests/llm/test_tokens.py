import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm import brute
from vaultrail.llm import bitpack, packing, token_counts, tokens

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PIECES = [" ", "  ", "\n", "\n\n", "a", "Foo", "'s", "é", "é", "́", "1", "23", "!", "...", "\t", "\r\n", " ", "　", "\x1c", "​", "᠎", "<|endoftext|>", "<|startoftext|>", "Σ", "你好", "😀", "﻿", "_", "\x00", "\x02", "^", "foo.", "bar,", "\x85", " ", "'ll", "İ"]


def library(name):
    own = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_ids_are_those_of_whole_texts(name, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    own, whole, rng = tokens.Encoder(public_tokenizers.path(name)), library(name), random.Random(0)
    for _ in range(4000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))
        assert own.ids(text).tolist() == whole(text), repr(text)


@pytest.mark.parametrize("name", FILES)
def test_marks_behind_letters_that_the_normalizer_changes(name):
    own, whole = tokens.Encoder(public_tokenizers.path(name)), library(name)
    for word in ["İ", "ab\u0130", "\u0958", "ΟΔΟΣ", "слово", "été", "ÀÉ", "ª", "²", "3", "가", "foo's", "<|endoftext|", "a<|endoftext|>b"]:
        for marks in [".", ",", "!!", ">^", "'", ".###", "_"]:
            for text in [word + marks, f"a {word}{marks} b {word}", f"a\n{word}{marks}\n{word}", f"a  {word}{marks}\t{word}\x02 \x02{word}"]:
                assert own.ids(text).tolist() == whole(text), repr(text)


@pytest.mark.parametrize("name", FILES)
def test_words_of_texts_are_looked_up_once(name, monkeypatch):
    own, whole, asked, given = tokens.Encoder(public_tokenizers.path(name)), library(name), [], []
    learn, encode = own.learn, own.tokenizer.encode_batch_fast

    class Library:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return encode(texts, **options)

    monkeypatch.setattr(own, "learn", lambda parts: asked.extend(map(str, parts)) or learn(parts))
    monkeypatch.setattr(own, "tokenizer", Library())
    texts = ["the été\nThe été!! übel??", None, "", "übel!! the été", "x the été"] * 300
    assert [np.frombuffer(r, "<u4").tolist() for r in own.raws(texts)] == [whole(t) for t in texts]
    assert len(asked) == len(set(asked))
    assert sorted(given) == ["!!", "??"]


def test_counts_and_cache(spark, tmp_path):
    rows, whole = brute.awkward(random.Random(0)), library(FILES[0])
    path, folder = public_tokenizers.path(FILES[0]), str(tmp_path / "cache")
    want = sorted(((r[0], len((r[1] or "").encode()), len(whole(r[1]))) for r in rows), key=repr)
    frame = spark.createDataFrame(rows, brute.DOCS)
    assert token_counts.token_counts(frame.limit(0), path, folder).collect() == []
    for _ in range(2):
        assert sorted(map(tuple, token_counts.token_counts(frame, path, folder).collect()), key=repr) == want
        assert token_counts.read_cache(spark, folder).count() == len({r[1] or "" for r in rows})
    # A stored count is believed, and another tokenizer's is not.
    other = public_tokenizers.path(FILES[1])
    again = token_counts.token_counts(frame, other, folder, normalise=lambda c: c)
    assert sorted((r.n_tokens for r in again.collect())) == sorted(len(library(FILES[1])(r[1])) for r in rows)


@pytest.mark.parametrize("width", [1, 5, 13, 16, 17, 31])
def test_bits(width):
    ids = np.random.default_rng(0).integers(0, 1 << width, 1001).astype(np.uint32)
    raw = bitpack.pack(ids, width)
    assert len(raw) == -(-1001 * width // 8)
    assert (bitpack.unpack(raw, width, 0, 1001) == ids).all()
    assert (bitpack.unpack(raw, width, 333, 77) == ids[333:410]).all()


def test_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bitpack, "BLOCK", 300)
    rows, whole = brute.awkward(random.Random(0)), library(FILES[0])
    folder = str(tmp_path / "ids")
    bitpack.write_ids(spark.createDataFrame(rows, brute.DOCS), folder, public_tokenizers.path(FILES[0]), 2, 50257)
    found = bitpack.read_documents(spark, folder).orderBy("start").collect()
    lists = {}
    for r in rows:
        lists.setdefault(r[0], []).append(np.array([*whole(r[1]), 2], "<u4"))
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in found if r.doc_id is not None) == sorted((i, len(x), zlib.crc32(x.tobytes())) for i, all_ in lists.items() if i is not None for x in all_)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    one = next(r for r in found if r.doc_id == 15)
    assert bitpack.read_ids(spark, folder, one.start, one.n_tokens).tolist() == lists[15][0].tolist()
    total = sum(r.n_tokens for r in found)
    assert len(bitpack.read_ids(spark, folder, 0, total)) == total
    bitpack.write_ids(spark.createDataFrame([], brute.DOCS), folder + "-none", public_tokenizers.path(FILES[0]), 2, 50257)
    assert bitpack.read_documents(spark, folder + "-none").collect() == []


def best_fit(counts, capacity):
    """Number of sequences of sequential best fit, longest first."""
    gaps, opened = [], 0
    for length in sorted((x for x, n in counts.items() for _ in range(n) if x < capacity), reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - length)
        else:
            opened += 1
            gaps.append(capacity - length)
    return opened


def test_supersteps_against_sequential_best_fit():
    rng = random.Random(0)
    for _ in range(150):
        capacity = rng.choice([5, 10, 64, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 25))}
        sequences, ranks = {}, {}
        for length, low, n, first, offset in packing.supersteps(counts, capacity):
            assert low == ranks.get(length, 0)
            ranks[length] = low + n
            for k in range(n):
                sequences.setdefault(first + k, []).append((offset, length))
        assert ranks == {x: n for x, n in counts.items() if x < capacity}
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(sequences) <= best_fit(counts, capacity) * 1.05 + 1


@pytest.mark.parametrize("capacity", [50, 2048])
def test_packed_pieces(spark, capacity):
    rows, whole = brute.awkward(random.Random(0)), library(FILES[1])
    frame = spark.createDataFrame(rows, brute.DOCS)
    found = packing.pack(frame, public_tokenizers.path(FILES[1]), 0, capacity).collect()
    want = []
    for r in rows:
        ids = np.array([*whole(r[1]), 0], "<u4")
        want += [(r[0], k, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(want, key=repr)
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) <= sum(r.length for r in found) / capacity * 1.15 + 2
    joined = packing.sequences(frame, public_tokenizers.path(FILES[1]), 0, capacity).collect()
    assert sorted(len(r.ids) for r in joined) == sorted(sum(x for _, x in parts) for parts in by.values())
    assert packing.pack(frame.limit(0), public_tokenizers.path(FILES[1])).collect() == []
