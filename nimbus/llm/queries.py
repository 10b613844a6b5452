"""One registered query per operator, with production parameters over whole tables.

``QUERIES`` maps a name to its function, ``ORACLES`` to DuckDB SQL where SQL can
express the result; the other queries are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.llm import conversation_audit, exact_dedup, fingerprints, hard_negatives, jaccard_join, near_dedup, ngram_lm, packing, source_mix, substring_dedup, token_counts, toxicity, url_filter
from nimbus.llm.common import crc_mod
from nimbus.sources.tables import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.source_mix(load(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op6_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(load(spark, sf_dir, "documents"))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op9_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY {_NORM}) AS keep_id,
       count(*) OVER (PARTITION BY {_NORM}) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY {_NORM}) AS kept,
       sha256({_NORM}) AS text_sha256
FROM documents"""


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.url_filter(load(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


@query
def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), keep=("doc_id",))
    held = (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op8_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(load(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(load(spark, sf_dir, "documents")).drop("kept")


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(load(spark, sf_dir, "documents"))


ORACLES["op11_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_NORM}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, p.y FROM r JOIN p ON p.x = r.reach)
SELECT s.doc_id, CAST(any_value(len(s.sh)) AS BIGINT) AS n_shingles, min(r.reach) AS component_id
FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 5"""


@query
def op13_conversation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations")
    return conversation_audit.audit(conversation_audit.damaged(turns), turns)
