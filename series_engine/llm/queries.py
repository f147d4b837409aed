"""One query per operator of the subpackage, over whole tables, and the DuckDB
SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_engine.llm import (ann, html, line_dedup, minhash, mixing, more_queries, packing, quality, substring, token_counts,
                               toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated windows of 35 words."""
    return substring.dedup_substrings(_table(spark, sf_dir, "documents"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of near-duplicates it is in."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, similarity=0.85)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(_table(spark, sf_dir, "pages"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest other vectors of every vector whose id is divisible by 100."""
    return ann.search(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and verdicts of every document."""
    led = quality.ledger(_table(spark, sf_dir, "documents"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~quality.passes("base")).alias("base_failed"),
                      quality.passes("v2").alias("kept"), "failure_bits")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its lines of recurring templates."""
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_kept_chars"),
                      F.md5("text").alias("kept_md5"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and the first place it takes it to."""
    mixed = mixing.per_document(mixing.mix(_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "n_draws", "first_shard", "first_position")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents")).drop("uid")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    out = toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "n_segments", "first_word", "last_word")


_WORDS = r"list_filter(string_split_regex({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP5_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT rid, doc_id, {_WORDS.format(t="t")} AS w,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) AS n, length(regexp_replace(t, '[A-Z]', '', 'g')) AS no_upper,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), g AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM m WHERE len(w) > 2)
), r AS (
  SELECT rid, count(DISTINCT p) AS n_repeat
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM g) WHERE k > 1)
  GROUP BY rid
), s AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, n - no_upper AS n_upper
  FROM m LEFT JOIN r USING (rid)
), b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
           + CASE WHEN 2 * n_upper > word_chars THEN 8 ELSE 0 END
           + CASE WHEN 10 * n_dup_lines > 5 * n_lines THEN 16 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 32 ELSE 0 END)::BIGINT AS failure_bits
  FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failure_bits & 3) <> 0 AS base_failed, (failure_bits & 63) = 0 AS kept, failure_bits
FROM b
"""

QUERIES = {
    "op4_ann": op4_ann,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op1_substring_dedup": op1_substring_dedup,
    "op6_token_counts": op6_token_counts,
    "op3_html_extraction": op3_html_extraction,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_mixing": op8_mixing,
    "op5_quality_rules": op5_quality_rules,
} | more_queries.QUERIES

ORACLE = {
    "op5_quality_rules": OP5_SQL,
} | more_queries.ORACLE
