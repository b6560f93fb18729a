"""Plain Python versions of the operators, and tables of awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket long, h string"


def words(text: str | None) -> list[bytes]:
    low = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    return WORD.findall(low)


def invented(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ré", "st", "un"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward(rng: random.Random) -> list[tuple]:
    """Rows with nulls in every column, empty, blank, short, repeated and very long texts, and clashing columns."""
    base = invented(rng, 120)
    passage = invented(rng, 60)
    cut = base.split()
    near = " ".join([*cut[:40], "edited", *cut[41:]])
    texts = [None, "", "  \n\t ", "one", "one two", "One  TWO", base, base, near, near + " tail", passage, invented(rng, 30) + " " + passage, passage + " " + invented(rng, 30)]
    texts += ["a" * 700, "ab " * 300, invented(rng, 9000), "é" * 300, "x" + "é" * 300, base[:200], base[:199]]
    texts += [invented(rng, rng.randint(1, 200)) for _ in range(40)]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 4}", None, i % 3, "clash") for i, t in enumerate(texts)]
    return [*rows, rows[6], rows[6], (None, base, None, None, None, None, None), (None, None, None, None, None, None, None), (7, invented(rng, 20), "en", "s1", 5, 1, None)]


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def ngrams(text: str | None, size: int) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def removed(texts: list[str | None], size: int) -> list[set[int]]:
    """Bytes of each text that a repeated string of ``size`` bytes covers."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + size] for r in raw for i in range(len(r) - size + 1))
    return [{j for i in range(len(r) - size + 1) if seen[r[i : i + size]] > 1 for j in range(i, i + size)} for r in raw]


def mix_targets(sizes: dict, weights=(5, 2, 1), limit=3.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    rest = float(sum(sizes.values()))
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share, rest = {s: rest * weight[s] / total for s in open_}, 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= limit * sizes[s]:
                rest += target[s] - limit * sizes[s]
                target[s] = limit * sizes[s]
                open_.discard(s)
    return target
