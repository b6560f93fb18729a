"""One registered query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.llm import ann, bitpack, brown_lm, hard_negatives, mixing, ngram_join, packing, pieces, prefix_trie, suffix_dedup, token_counts, topk, toxicity
from vaultrail.llm.tables import small_batches
from vaultrail.plans.registry import registrar
from vaultrail.session import work_folder

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def fold(modulus: int):
    """crc32 of the doc_id as text, by remainder."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Noisy-or of sentence scores, learned from the labels of three folds out of four."""
    documents = read(spark, folder, "documents")
    model = toxicity.fit(documents.where(fold(4) != 2), read(spark, folder, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


@query(r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w),
n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s),
t AS (SELECT doc_id, unnest(g) AS g FROM s),
r AS (SELECT doc_id, g, count(*) OVER (PARTITION BY g) AS df FROM t),
p AS (SELECT r.doc_id, g, n, row_number() OVER (PARTITION BY r.doc_id ORDER BY df, g) AS nr FROM r JOIN n USING (doc_id)),
f AS (SELECT doc_id, g FROM p WHERE nr <= n - ceil(n * 0.9) + 1),
c AS (SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM f a JOIN f b ON a.g = b.g AND a.doc_id < b.doc_id),
i AS (SELECT u, v, count(*) AS i FROM c JOIN t a ON a.doc_id = u JOIN t b ON b.doc_id = v AND a.g = b.g GROUP BY u, v),
e AS (SELECT u, v FROM i JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 90 * (a.n + b.n - i)),
b AS MATERIALIZED (SELECT u, v FROM e UNION SELECT v, u FROM e),
k AS (
  WITH RECURSIVE q(doc_id, seen) AS (SELECT doc_id, doc_id FROM n UNION SELECT q.doc_id, b.v FROM q JOIN b ON b.u = q.seen)
  SELECT doc_id, min(seen) AS component_id FROM q GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id FROM n JOIN k USING (doc_id)
""")
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of the documents that share nine tenths of their three-word shingles."""
    found = ngram_join.similarity_components(read(spark, folder, "documents"), size=3, percent=90)
    return found.select("doc_id", F.col("n_ngrams").alias("n_shingles"), "component_id")


@query()
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix by source weights takes of each document."""
    return mixing.taken_copies(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query()
def op4_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities under a class bigram model learned from six folds out of seven."""
    documents = read(spark, folder, "documents")
    model = brown_lm.fit(documents.where(fold(7) != 2))
    scored = brown_lm.score(documents, model)
    return scored.select("doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query()
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each text without the bytes of repeated 200-byte strings."""
    found = suffix_dedup.removed_spans(read(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
""")
def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 highest inner products of each twentieth vector."""
    return topk.exact_top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query()
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences of 2048."""
    return packing.pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=0, capacity=2048)


@query()
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all texts through a cache that starts empty."""
    counted = token_counts.token_counts(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), work_folder(spark, "token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query()
def op9_bit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Ids written in fixed-width bits and read back."""
    target = work_folder(spark, "token-ids")
    bitpack.write_ids(read(spark, folder, "documents"), target, public_tokenizers.path("byte_bpe_50k.json"), end=2, vocabulary=50257)
    return bitpack.read_documents(spark, target)


@query()
def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors found for each fiftieth vector."""
    return ann.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_dot_product(a.w, c.w)::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The ten hardest negatives, from 30 to 90 per cent of the score, for five positives of each hundredth vector."""
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.hard_negatives(read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query("""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(role || text)) AS position, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295::BIGINT, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda d: list_concat([ascii(d)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS later, position, role, text FROM c JOIN t ON t.conv_id = base AND position <= h
  UNION ALL SELECT c.conv_id, 1, position, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND position > h),
l AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY later, position) AS turns FROM r GROUP BY conv_id),
m AS (SELECT c.conv_id, coalesce(turns, []) AS turns, coalesce(len(turns), 0) AS n FROM c LEFT JOIN l USING (conv_id)),
p AS (
  SELECT conv_id, n, d, sha256(to_json(turns[1:d])::VARCHAR) AS k, CASE WHEN d > 0 THEN sha256(to_json(turns[1:d - 1])::VARCHAR) END AS up,
    CASE WHEN d > 0 THEN strlen(turns[d].text) ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(0, n + 1)) AS d FROM m)),
v AS (
  SELECT k, min(up) AS up, min(conv_id) AS conv_id, min(d) AS depth, count(*) AS n_convs, min(bytes) AS bytes,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n) AS ends FROM p GROUP BY k),
n AS (SELECT up AS k, count(*) AS n_children FROM v WHERE up IS NOT NULL GROUP BY up),
w AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN n USING (k)),
s AS (SELECT DISTINCT a.k, b.k AS below FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.d <= b.d),
g AS (SELECT s.k, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens FROM s JOIN w ON w.k = s.below GROUP BY s.k)
SELECT w.conv_id, w.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN g USING (k) LEFT JOIN v o ON o.k = w.up
""")
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of conversations that begin with the first turns of another one."""
    turns = prefix_trie.numbered_turns(read(spark, folder, "conversations"))
    rebuilt, members = prefix_trie.shared_openings(turns)
    return prefix_trie.trie_nodes(rebuilt, members).drop("d1", "d2")


@query()
def op13_piece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of whole texts by backtracking, and digests of the ids and of the text they give."""
    found = pieces.encode(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), end=True, decoded=True)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
