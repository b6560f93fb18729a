import random

from pyspark.sql import functions as F

from llm import brute
from vaultrail.llm import toxicity


def labelled(spark):
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(600):
        toxic = rng.random() < 0.2
        sentences = [brute.invented(rng, rng.randint(2, 9)) for _ in range(rng.randint(1, 12))]
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(["nasty", "vile"])
        rows.append((i, ". ".join(sentences) + ".", "en", "s", 1, 1, "x"))
        marks.append((i, int(toxic), 1))
    marks += [(None, 1, 1), (1, None, 0), (10_000, 1, 1), (2, 7, 1)]
    return rows, spark.createDataFrame(marks, "doc_id long, toxic int, text int")


def test_held_out_documents_and_sentences(spark):
    rows, labels = labelled(spark)
    frame = spark.createDataFrame(rows, brute.DOCS)
    model = toxicity.fit(frame.where("doc_id % 4 <> 2"), labels)
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id < 600 and toxic in (0, 1)").collect()}
    found = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    held = [i for i in truth if i % 4 == 2]
    right = [(found[i].score >= 0.3) == (truth[i] == 1) for i in held]
    assert sum(right) / len(right) > 0.97
    for i in held:
        for span in found[i].offending:
            sentence = rows[i][1][span["start"] : span["end"]]
            assert "nasty" in sentence or "vile" in sentence
    assert all(0 <= r.score <= 1 for r in found.values())
    assert toxicity.toxic_rows(frame, model).count() == sum(r.score < 0.3 for r in found.values())


def test_awkward_rows(spark):
    rows, labels = labelled(spark)
    model = toxicity.fit(spark.createDataFrame(rows, brute.DOCS), labels)
    odd = brute.awkward(random.Random(0))
    found = toxicity.score(spark.createDataFrame(odd, brute.DOCS), model).collect()
    assert len(found) == len(odd)
    assert {r.score for r in found if r.doc_id in (0, 1)} == {0.0}
    assert toxicity.score(spark.createDataFrame([], brute.DOCS), model).collect() == []
    none = toxicity.fit(spark.createDataFrame([], brute.DOCS), labels)
    assert toxicity.score(spark.createDataFrame(odd, brute.DOCS), none).agg(F.max("score")).first()[0] < 1e-9


def test_noisy_or_is_one_minus_the_product():
    model = toxicity.Model({"bad": 6.0, "good": -2.0}, -4.0)
    text = "Bad thing. A good thing! nothing\n\nbad good"
    odds = [2.0, -6.0, 0.0]  # a sentence without any of the words is clean
    clean = 1.0
    for x in odds:
        clean *= 1 - 1 / (1 + 2.718281828459045**-x)
    assert abs(model.document(text)[0] - (1 - clean)) < 1e-9


def test_long_clean_texts_stay_clean(spark):
    rows, labels = labelled(spark)
    model = toxicity.fit(spark.createDataFrame(rows, brute.DOCS), labels)
    rng = random.Random(6)
    clean = ". ".join(brute.invented(rng, 5) for _ in range(4000))
    assert model.document("quartz fjord. " * 10_000)[0] == 0.0
    assert model.document(clean)[0] < 0.3
    assert model.document(clean + ". You nasty vile thing")[0] > 0.5


def test_long_clean_texts_of_the_test_data(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    texts = [r.text or "" for r in documents.join(labels.where("toxic = 0"), "doc_id").collect()]
    words = " ".join(texts).split()[:20_000]
    assert len(words) == 20_000
    assert model.document(". ".join(" ".join(words[i : i + 10]) for i in range(0, len(words), 10)))[0] < 0.3


def test_the_fit_lowers_the_loss_of_the_sample(spark):
    import numpy as np
    import pandas as pd

    sample = pd.DataFrame({"label": [1] * 20 + [0] * 60, "hits": ["0;1 2"] * 15 + ["2"] * 5 + ["1"] * 30 + [""] * 30})
    weights, bias = toxicity._descend(sample, 3, {1: 20, 0: 60})
    model = toxicity.Model({w: float(x) for w, x in zip("abc", weights, strict=True)}, bias)

    def loss(model):
        texts = [". ".join("".join("abc"[int(i)] + " " for i in part.split()) for part in hits.split(";")) for hits in sample["hits"]]
        p = np.clip([model.document(t)[0] for t in texts], 1e-9, 1 - 1e-9)
        return -np.log(np.where(sample["label"] == 1, p, 1 - p)).mean()

    assert loss(model) < 0.05 < loss(toxicity.Model({"a": 1.0, "b": 1.0, "c": 1.0}, toxicity.PRIOR))
    for shift in (-0.5, 0.5):  # near the least loss, so moving a weight that matters makes it worse or changes next to nothing
        moved = toxicity.Model(model.weights | {"c": model.weights["c"] + shift}, bias)
        assert loss(moved) > loss(model) - 0.01
