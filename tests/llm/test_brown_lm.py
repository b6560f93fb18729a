import math
import random
from collections import Counter

import numpy as np
import pytest

from llm import brute
from vaultrail.llm import brown_lm

SMALL = {"head": 40, "endings": 5, "classes": 8, "rounds": 4, "held": 10}


def corpus():
    rng = random.Random(6)
    noun, verb = [f"n{i}x" for i in range(20)], [f"v{i}y" for i in range(20)]
    rows = [(i, " ".join(f"{rng.choice(noun)} {rng.choice(verb)}" for _ in range(rng.randint(1, 20))), "", "", 1, 1, "") for i in range(300)]
    return rows, rng


def plain(model, texts, training):
    """Scores word by word, from counts of words and the model's classes."""
    counts = Counter(w for t in training for w in brute.words(t))
    n, v = sum(counts.values()) + len(training), len(counts) + 1
    head, end, out = model.units.head.tolist(), model.units.end, []
    mass = Counter()

    def cls(word):
        h = brown_lm._tokens(np.frombuffer(word, np.uint8), np.array([0, len(word)]))
        return int(model.own[model.units.of(h[1], h[2])[0]])

    for w, c in counts.items():
        mass[cls(w)] += c
    for t in texts:
        at, base, score, known = int(model.own[end]), 0.0, 0.0, 1
        for w in brute.words(t):
            to, c = cls(w), counts[w]
            score += model.step[at, to] + (math.log10((c - model.discount) / mass[to]) if c else model.unseen[to])
            base += math.log10((c + 1) / (n + v + 1))
            known, at = known + (c > 0), to
        base += math.log10((len(training) + 1) / (n + v + 1))
        out.append((len(brute.words(t)) + 1, known, round(base, 6), round(score + model.step[at, model.own[end]], 6)))
    assert len(set(head)) == len(head)
    return n, out


def test_scores_and_gain(spark):
    rows, rng = corpus()
    odd = [(1000 + i, *r[1:]) for i, r in enumerate(brute.awkward(rng))]
    training = [r[1] for r in rows if r[0] % 7 != 2]
    model = brown_lm.fit(spark.createDataFrame([r for r in rows if r[0] % 7 != 2], brute.DOCS), **SMALL)
    frame = spark.createDataFrame(rows + odd + [odd[3]], brute.DOCS)
    found = sorted(brown_lm.score(frame, model).collect(), key=lambda r: r.doc_id)
    every = sorted(rows + odd + [odd[3]], key=lambda r: r[0])
    tokens, want = plain(model, [r[1] for r in every], training)
    assert model.tokens == tokens
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in found] == [(a, b, pytest.approx(c, abs=1e-5), pytest.approx(d, abs=1e-5)) for a, b, c, d in want]
    held = [r for r in found if r.doc_id < 1000 and r.doc_id % 7 == 2]
    n = sum(r.n_tokens for r in held)
    # Two kinds of words that alternate: knowing the kind before halves the choice.
    assert brown_lm.perplexity(sum(r.score for r in held), n) < 0.7 * brown_lm.perplexity(sum(r.base_score for r in held), n)


def test_probabilities_sum_to_one(spark):
    rows, _ = corpus()
    model = brown_lm.fit(spark.createDataFrame(rows, brute.DOCS), **SMALL)
    assert np.allclose((10.0**model.step).sum(1), 1)
    words = {w for r in rows for w in brute.words(r[1])}
    total = np.zeros(len(model.mass))
    counts = Counter(w for r in rows for w in brute.words(r[1]))
    for w in words:
        _, h, tail = brown_lm._tokens(np.frombuffer(w, np.uint8), np.array([0, len(w)]))
        c = model.own[model.units.of(h, tail)[0]]
        total[c] += 10.0 ** float(model.emission(np.array([counts[w]]), np.array([c]))[0])
    used = model.mass > 0
    assert np.allclose((total + 10.0**model.unseen)[used], 1, atol=1e-6)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.3, (30, 30)).astype(float)
    counts[:10, 10:20] += rng.poisson(5, (10, 10))
    counts[10:20, :10] += rng.poisson(5, (10, 10))

    def value(own):
        member = np.eye(own.max() + 1)[own]
        n = member.T @ counts @ member
        f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-9)), 0).sum()
        return f(n) - 2 * f(n.sum(0))

    values = [value(brown_lm.exchange(counts, 5, r)) for r in (0, 1, 4)]
    assert values[0] < values[1] <= values[2] + 1e-6


def test_nothing_to_learn_from(spark):
    rows = brute.awkward(random.Random(0))
    model = brown_lm.fit(spark.createDataFrame([], brute.DOCS))
    found = brown_lm.score(spark.createDataFrame(rows, brute.DOCS), model).collect()
    assert len(found) == len(rows) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)
    assert brown_lm.score(spark.createDataFrame([], brute.DOCS), model).collect() == []


def test_words_beyond_the_head_have_classes_of_their_own(spark):
    rows, rng = corpus()
    odd = [(1000 + i, *r[1:]) for i, r in enumerate(brute.awkward(rng))]
    training = [r for r in rows if r[0] % 7 != 2]
    model = brown_lm.fit(spark.createDataFrame(training, brute.DOCS), **SMALL | {"head": 20, "endings": 2})
    counts = Counter(w for r in training for w in brute.words(r[1]))
    n, v = sum(counts.values()) + len(training), len(counts) + 1
    learned = {r.h: (r.cls, r.n) for r in model.words.collect()}

    def fingerprint(word):
        _, h, tail = brown_lm._tokens(np.frombuffer(word, np.uint8), np.array([0, len(word)]))
        return int(h[0]), int(model.own[model.units.of(h, tail)[0]])

    def cls(word):
        h, by_ending = fingerprint(word)
        return learned[h][0] if h in learned else by_ending

    assert sorted(n for _, n in learned.values()) == sorted(counts.values()) and all(learned[fingerprint(w)[0]][1] == c for w, c in counts.items())
    # All transitions are those of the words' own classes.
    between, end = np.zeros(model.step.shape), len(model.step) - 1
    for r in training:
        path = [end, *map(cls, brute.words(r[1])), end]
        np.add.at(between, (path[:-1], path[1:]), 1)
    assert np.allclose(model.step, brown_lm._steps(between))
    # Nouns and verbs never share a class, of whatever rank and ending.
    kinds = Counter((cls(w), w[:1]) for w in counts)
    assert len({c for c, _ in kinds}) == len(kinds)
    found = brown_lm.score(spark.createDataFrame(rows + odd, brute.DOCS), model).collect()
    texts = {r[0]: r[1] for r in rows + odd if r[0] is not None}
    mass = Counter()
    for w, c in counts.items():
        mass[cls(w)] += c
    for r in found:
        path = brute.words(texts[r.doc_id])
        want, at = 0.0, end
        for w in path:
            c, to = counts[w], cls(w)
            want, at = want + model.step[at, to] + (math.log10((c - model.discount) / mass[to]) if c else model.unseen[to]), to
        assert (r.n_tokens, r.n_known) == (len(path) + 1, 1 + sum(w in counts for w in path))
        assert r.score == pytest.approx(want + model.step[at, end], abs=1e-5)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in path) + math.log10((len(training) + 1) / (n + v + 1)), abs=1e-5)
    held = [r for r in found if r.doc_id < 1000 and r.doc_id % 7 == 2]
    n = sum(r.n_tokens for r in held)
    assert brown_lm.perplexity(sum(r.score for r in held), n) < 0.7 * brown_lm.perplexity(sum(r.base_score for r in held), n)
