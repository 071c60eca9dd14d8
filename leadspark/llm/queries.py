"""Queries ``opN_<name>``: each operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    html_content, langid, packing, pivots, rules, sampling, secrets, simhash, sketch, tokens, toxicity, turns, whitening,
)
from .common import documents
from .registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MAX_TOKENS = 2048
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query("op2_secret_scan")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, folder))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secrets.joined("base_spans"), 256).alias("base_sha256"),
        secrets.joined("spans").alias("spans"),
    )


@query("op3_best_fit_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), BYTE_BPE, packing.Capacity(tokens=MAX_TOKENS))


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    near = simhash.near_duplicates(documents(spark, folder), words=4, most=4)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    scores = toxicity.score_documents(docs, toxicity.train(docs, documents(spark, folder, "labels")))
    return scores.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


@query("op9_document_fingerprints")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    rows = sketch.document_fingerprints(documents(spark, folder))
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch.shown(own).alias("fingerprint"), sketch.shown(edited).alias("edited_fingerprint"),
        sketch.resemblance(own, edited).alias("near_edited"), sketch.resemblance(own, following).alias("near_next"),
        sketch.containment(own, edited).alias("contained_in_edited"), sketch.distinct_shingles(own).alias("n_shingles"),
    )


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, folder), PIECES)


OP10_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op10_pivot_top_k", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.top_products(documents(spark, folder, "embeddings"), query_every=50, k=5, factor=256)


@query("op4_sampled_pieces")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample_segmentations(documents(spark, folder), PIECES)


@query("op8_html_content")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return html_content.extract_pages(documents(spark, folder, "pages"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(documents(spark, folder, "embeddings"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return turns.digested(turns.repair(turns.damaged(documents(spark, folder, "conversations")))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), places AS (
  SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS start FROM d
), windows AS (
  SELECT id, start, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w
                    || ' ' || lead(word, 4) OVER w AS words
  FROM places WINDOW w AS (PARTITION BY id ORDER BY start)
), counted AS (
  SELECT id, start, count(*) OVER (PARTITION BY id, words) AS n FROM windows WHERE words IS NOT NULL
), repeats AS (
  SELECT id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT id, unnest(range(start, start + 5)) AS place FROM counted WHERE n > 1) GROUP BY id
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) AS BIGINT) AS n_letter_words,
         CAST(len(lines) AS BIGINT) AS n_lines
  FROM d LEFT JOIN repeats USING (id)
), failed AS (
  SELECT *, CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 10 * n_letter_words < 8 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN n_words > 1000000 THEN 64 ELSE 0 END AS BIGINT) AS failed_rules
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_rules & 3) <> 0 AS base_failed, (failed_rules & 31) = 0 AS kept, failed_rules
FROM failed
"""


@query("op13_quality_rules", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge(rules.ledger(documents(spark, folder)), rules.policy("web", 2))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rules.removed(rules.policy("web", 1)).alias("base_failed"), "kept", F.col("bits").alias("failed_rules"))
