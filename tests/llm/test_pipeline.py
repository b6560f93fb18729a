import os

import corpus_pipeline
from llm import brute
from vaultrail.llm import mixing, suffix_dedup, toxicity

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept, steps = documents, {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, kept = kept, stage(spark, kept, FOLDER).cache()
        steps[name] = (before.collect(), kept.collect())
        assert kept.columns == documents.columns
    before, after = steps["ngram_join"]
    sets = {r.doc_id: brute.ngrams(r.text, 5) for r in before}
    edges = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    groups = brute.components(sets, edges)
    assert sorted(r.doc_id for r in after) == sorted(i for i, g in groups.items() if i == g)
    before, after = steps["suffix_dedup"]
    gone = dict(zip([r.doc_id for r in before], brute.removed([r.text for r in before], suffix_dedup.SIZE), strict=True))
    texts = {r.doc_id: r.text for r in after}
    for r in before:
        left = bytes(b for i, b in enumerate((r.text or "").encode()) if i not in gone[r.doc_id])
        assert texts[r.doc_id].encode() == left or len(texts[r.doc_id].encode()) - len(left) in range(12)
    before, after = steps["mixing"]
    assert len(after) == mixing.taken_copies(spark.createDataFrame(before, documents.schema)).agg({"copies": "sum"}).first()[0]
    packed = corpus_pipeline.STAGES[4][1](spark, kept, FOLDER)
    assert packed.select("doc_id").where("piece = 0").count() == len(after)


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def left(spark, rows):
    return sorted(((r.doc_id, r.text) for r in corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, SCHEMA), FOLDER).collect()), key=repr)


def test_one_row_stays_of_repeated_rows(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "t", 1), (2, "a b c d e f g", "en", "s", 1), (3, "", "en", "s", 0), (3, None, None, None, None), (None, "z y x", None, None, None)]
    assert left(spark, rows) == sorted([(1, "a b c d e f g"), (3, ""), (3, None), (None, "z y x")], key=repr)


def test_unrelated_texts_under_one_id_all_stay(spark):
    one, two, three = "a b c d e f g", "q w e r t y u", "m n b v c x z"
    assert left(spark, [(i, t, None, None, None) for i, t in [(1, one), (1, two), (2, one), (3, two)]]) == [(1, one), (1, two)]
    assert left(spark, [(i, t, None, None, None) for i, t in [(5, one), (5, two), (2, one), (3, two), (4, three)]]) == sorted([(2, one), (3, two), (4, three)])
    # Rows without doc_id are known by their texts; one that has an id is preferred.
    assert left(spark, [(i, t, None, None, None) for i, t in [(None, one), (None, one), (None, two), (9, two), (None, None)]]) == sorted([(None, one), (9, two), (None, None)], key=repr)


def test_columns_of_any_name_come_back(spark):
    names = ["dedup_key", "dedup_spans", "mix_key", "mix_h", "mix_copies", "mix_nth", "nth", "row", "key", "content", "own", "digest", "stays", "component_id", "again", "own_id", "a", "h"]
    passage = " ".join(f"word{i}" for i in range(60))
    texts = [passage + " one tail", "other start " + passage, "a b c d e f g", "a b c d e f g", "short"]
    rows = [(i, t, "en", f"s{i % 2}", len(t), *(f"{n}-{i}" for n in names)) for i, t in enumerate([*texts, texts[4]])]
    frame = spark.createDataFrame([*rows, rows[5]], SCHEMA + "".join(f", {n} string" for n in names))
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.drop_repeated_strings, corpus_pipeline.mix_sources):
        out = stage(spark, frame, FOLDER)
        assert out.columns == frame.columns
        found = out.collect()
        assert found and all(r[n] == f"{n}-{r.doc_id}" for r in found for n in names)
    packed = corpus_pipeline.pack_sequences(spark, frame, FOLDER)
    assert packed.where("piece = 0").count() == 7
    model = toxicity.Model({"short": 5.0}, 0.0)
    assert sorted(r.key for r in toxicity.toxic_rows(frame, model).collect()) == [f"key-{i}" for i in range(4)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).collect() == []
