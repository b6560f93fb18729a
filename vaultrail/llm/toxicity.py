"""Toxicity by multiple-instance learning: a document is toxic if at least one of its sentences is.

A sentence has the words it contains as features and a logistic score p. The score of a document is the noisy-or of its
sentences, ``1 - prod(1 - p)``, so weights are learned from document labels alone and still tell which sentences offend.

A sentence without any vocabulary word has probability 0, so a clean text of any length scores 0.

The vocabulary comes from counts over all labelled documents: the words whose presence tells the labels apart by the
likelihood ratio, as far as the sample below has them, which bounds their number. The weights are fitted on a bounded sample of labelled documents (``SAMPLE`` per label, by hash),
each of which is reduced to its sentences' vocabulary words first; label weights restore the true share of the labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultrail.llm.tables import join_narrow, pick
from vaultrail.session import materialise

#: Labelled documents per label in the fit at most.
SAMPLE = 6000
#: Log odds of a sentence before its words are seen, to which the bias is pulled.
PRIOR = -6.0
#: Documents a word must occur in, and a likelihood ratio it must reach, to be a feature.
LEAST_DOCUMENTS, LEAST_RATIO = 5, 15.0

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Model:
    """Word weights and bias of a sentence's log odds."""

    weights: dict[str, float]
    bias: float

    def sentence(self, text: str) -> float | None:
        """Log odds, or None if the sentence has no vocabulary word."""
        hits = self.weights.keys() & set(_WORD.findall(text.lower()))
        return self.bias + sum(self.weights[w] for w in sorted(hits)) if hits else None

    def document(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of the sentences, and (start, end, score) of those with vocabulary words."""
        spans = [m.span() for m in _SENTENCE.finditer(text)]
        if not spans:
            return 0.0, []
        scored = []
        if not self.weights.keys().isdisjoint(_WORD.findall(text.lower())):
            for a, b in spans:
                odds = self.sentence(text[a:b])
                if odds is not None:
                    scored.append((a, b, float(1 / (1 + np.exp(-odds)))))
        clean = sum(np.log1p(-min(p, 1 - 1e-12)) for _, _, p in scored)
        return float(0.0 - np.expm1(min(clean, 0.0))), scored


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, documents with label 1, with label 0), summed within a batch."""
    for frame in batches:
        for begin in range(0, len(frame), 500):
            part = frame.iloc[begin : begin + 500]
            found = [Counter(), Counter()]
            for text, label in zip(part["text"], part["label"], strict=True):
                found[label].update(set(_WORD.findall((text or "").lower())))
            words = list(found[0] | found[1])
            yield pd.DataFrame({"word": words, "ones": [found[1][w] for w in words], "zeros": [found[0][w] for w in words]})


def vocabulary(labelled: DataFrame, n1: int, n0: int, seen: DataFrame) -> list[str]:
    """Words of ``seen`` (a bounded sample of rows) that tell the ``n1`` documents with label 1 from the ``n0`` with label 0, best first."""
    words = labelled.select("text", "label").mapInPandas(_word_counts, "word string, ones long, zeros long")
    words = words.groupBy("word").agg(F.sum("ones").alias("a"), F.sum("zeros").alias("b")).where(F.col("a") + F.col("b") >= LEAST_DOCUMENTS)

    def term(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    share, total = (F.col("a") + F.col("b")) / (n1 + n0), F.lit(0.0)
    for name, n in (("a", n1), ("b", n0)):
        total = total + term(F.col(name), share * n) + term(n - F.col(name), (1 - share) * n)
    here = seen.select("text", F.lit(0).alias("label")).mapInPandas(_word_counts, "word string, ones long, zeros long").select("word").distinct()
    best = words.select("word", (2 * total).alias("ratio")).where(F.col("ratio") >= LEAST_RATIO).join(here, "word", "left_semi")
    return [r["word"] for r in sorted(best.collect(), key=lambda r: (-r["ratio"], r["word"]))]


def _instances(index: dict[str, int]):
    """Per document: the vocabulary words of the sentences that have any, as 'i i;i'."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for text in frame["text"]:
                sentences = _SENTENCE.findall((text or "").lower())
                hits = (sorted(index[w] for w in index.keys() & set(_WORD.findall(s))) for s in sentences)
                rows.append(";".join(" ".join(map(str, h)) for h in hits if h))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "hits": rows})

    return run


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``documents(doc_id, text)`` whose ``labels(doc_id, toxic)`` is 0 or 1.

    Rows without a label, a doc_id or a label of 0 or 1 are left out. If one of the labels never occurs, every score is 0.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    known = materialise(known, "toxic-labels")
    # What needs no text: how many documents have each label, and the hash up to which they are in the sample.
    ids = join_narrow(pick(documents, "doc_id"), known, "doc_id").withColumn("h", F.xxhash64(F.lit(7), "doc_id"))
    sizes = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, -50.0)
    parts = [ids.where(F.col("label") == k).orderBy("h").select("doc_id", "h", "label").limit(SAMPLE) for k in (0, 1)]
    chosen = materialise(parts[0].unionByName(parts[1]).select("doc_id", "label").distinct(), "toxic-sample")
    taken = pick(documents, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    words = vocabulary(join_narrow(pick(documents, "doc_id", "text"), known, "doc_id"), sizes[1], sizes[0], taken)
    if not words:
        return Model({}, -50.0)
    index = {w: i for i, w in enumerate(words)}
    # A doc_id with several rows counts once, so the sample is bounded whatever the table.
    sample = taken.mapInPandas(_instances(index), "doc_id long, label int, hits string")
    sample = sample.groupBy("doc_id", "label").agg(F.min("hits").alias("hits")).select("label", "hits").toPandas()
    sample = sample.sort_values(["label", "hits"], ignore_index=True)
    weights, bias = _descend(sample, len(words), sizes)
    return Model({w: float(weights[i]) for w, i in index.items() if weights[i]}, bias)


def _descend(sample: pd.DataFrame, size: int, sizes: dict[int, int], rounds: int = 400, rate: float = 0.1, decay: float = 2e-5, pull: float = 1e-3) -> tuple[np.ndarray, float]:
    """Adam on the noisy-or log loss; documents weigh so that both labels have their true share."""
    y = sample["label"].to_numpy()
    taken = np.bincount(y, minlength=2)
    weight = np.array([sizes.get(k, 0) / max(1, taken[k]) for k in (0, 1)])[y]
    weight = weight / weight.sum()
    document, sentence, word = [], [], []
    owner = []
    for d, hits in enumerate(sample["hits"]):
        for part in hits.split(";") if hits else ():
            ids = list(map(int, part.split()))
            word += ids
            sentence += [len(owner)] * len(ids)
            owner.append(d)
    owner, sentence, word = np.array(owner, int), np.array(sentence, int), np.array(word, int)
    theta = np.zeros(size + 1)
    theta[-1] = PRIOR
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        odds = theta[-1] + np.bincount(sentence, theta[word], minlength=len(owner))
        clean = np.bincount(owner, -np.logaddexp(0, odds), minlength=len(y))
        # d loss / d(-log clean): 1 for label 0, -clean/(1-clean) for label 1
        slope = weight * np.where(y == 1, -1 / np.expm1(np.maximum(-clean, 1e-9)), 1.0)
        by_sentence = slope[owner] / (1 + np.exp(-odds))
        gradient = np.zeros_like(theta)
        gradient[:-1] = np.bincount(word, by_sentence[sentence], minlength=size) + decay * theta[:-1]
        gradient[-1] = by_sentence.sum() + pull * (theta[-1] - PRIOR)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def score(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Per row: doc_id, score (0 to 1), and the offending sentences, (start, end, score) in characters.

    A sentence offends if its own score reaches ``least``. A null or empty text scores 0 and has none. Every row, repeated
    ones and those without doc_id too, gives one row; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            scored = [model.document(t or "") for t in frame["text"]]
            offending = [[{"start": a, "end": b, "score": p} for a, b, p in spans if p >= least] for _, spans in scored]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": [s for s, _ in scored], "offending": offending})

    return pick(documents, "doc_id", "text").mapInPandas(run, "doc_id long, score double, offending array<struct<start:int,end:int,score:double>>")


def toxic_rows(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``documents`` that score below ``threshold``, with all their columns.

    A null or empty text scores 0. Rows without doc_id and repeated rows are judged as any other.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([model.document(t or "")[0] for t in texts], dtype=float)

    return documents.where(of(documents["text"]) < threshold)
