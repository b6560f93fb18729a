import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from llm import brute
from vaultrail.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


def test_ids_and_texts_are_the_library_s(model, library):
    rng = random.Random(0)
    letters = "aaab  \n\t▁é0123.,<>s/日本語の\u0000🙂ßtheingаbсё"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "   ", "▁", " a", "a ", "</s>", "<0x41>", "a" * 3000, " " * 100, "日" * 500, "\U0010ffff", "1234567890" * 50]
    for text, raw in zip(texts, model.encode(texts), strict=True):
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == library.encode(text), text
        assert model.decode(ids) == library.decode(ids.tolist())


def test_any_ids_decode_as_the_library_decodes_them(model, library):
    rng = random.Random(1)
    for _ in range(4000):
        ids = [rng.choice([rng.randint(0, 31_999), rng.randint(3, 258), 1, 2, 0, 29_871]) for _ in range(rng.randint(0, 12))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_backtracking_gives_what_merging_gives(model):
    rng = random.Random(2)
    # Pieces put side by side at random often disagree, so that longest matches fail.
    vocabulary = sorted(model.made)
    for _ in range(3000):
        text = "".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 5))).replace(pieces.SPACE, "")
        assert model.cover(text) == model.merged(text), text


def test_failed_places_are_tried_once(model):
    for part in ("z" * 20_000, "日本" * 5000, "abcdefghijklmnopqrstuvwxyz" * 800):
        calls = 0
        before = model.shorter

        def counted(piece):
            nonlocal calls
            calls += 1
            return before(piece)

        model.shorter = counted
        try:
            assert "".join(model.cover(part)) == part
        finally:
            del model.shorter
        assert calls <= 16 * len(part)


def test_forgetting_keeps_results(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    monkeypatch.setattr(pieces, "PAIRS", 10)
    small = pieces.PieceModel(PATH)
    rng = random.Random(3)
    for _ in range(40):
        texts = [brute.invented(rng, rng.randint(0, 30)) for _ in range(5)]
        assert [np.frombuffer(r, "<u4").tolist() for r in small.encode(texts)] == library.encode(texts)


def test_other_models_are_refused():
    with pytest.raises(Exception):  # noqa: B017
        pieces.PieceModel(public_tokenizers.path("word_bpe_49k.json"))


def test_awkward_rows(spark, library):
    rows = brute.awkward(random.Random(4))
    docs = spark.createDataFrame(rows, brute.DOCS)
    found = pieces.encode(docs, PATH, decoded=True).collect()
    want = [(r[0], library.encode(r[1] or "") + [library.eos_id()]) for r in rows]
    assert sorted(((r.doc_id, list(r.ids), r.decoded) for r in found), key=repr) == sorted(((d, ids, library.decode(ids)) for d, ids in want), key=repr)
    back = pieces.decode(pieces.encode(docs, PATH), PATH)
    assert sorted(back.collect(), key=repr) == sorted(((r.doc_id, r.decoded) for r in found), key=repr)
    assert pieces.encode(docs.limit(0), PATH).collect() == []


def test_query_digests(spark, library):
    from vaultrail.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op13_piece_round_trip"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = [*library.encode(r.text or ""), library.eos_id()]
        got = found.pop(r.doc_id)
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert not found
