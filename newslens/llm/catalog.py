"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import (ctw, fill_middle, html_extract, langid, lexical_rank, line_rules,
                          mixing, oracle, packing, simhash, suffix_dedup, syncmers, topk,
                          warc)
from newslens.llm.common import fold, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = ctw.held_out()
    return ctw.score(docs, ~held_out & F.col("doc_id").isNotNull()).withColumn(
        "held_out", held_out)


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest",
                                           "record_type", "refers_to")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", langid.FOLDS) == langid.HELD_OUT, F.lit(False))
    return langid.identify(docs, langid.learnable(), keep=("doc_id",)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_line_first_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_removed_lines", "removed_chars")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.transform(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias(
            "restored_sha256"))


def op13_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.rank(table(spark, sf_dir, "documents"),
                             table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_html_main_text, op2_harmonic_packing, op3_closed_syncmers, op4_source_mixing,
    op5_exact_top_k, op6_context_tree_weighting, op7_warc_archive, op8_suffix_array_dedup,
    op9_simhash_near_dedup, op10_language_id, op11_line_first_rules, op12_fill_in_middle,
    op13_lexical_rank)}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(q) AS w, generate_subscripts(q, 1) AS d FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.w * b.w) AS BIGINT) AS score
  FROM c a JOIN c b ON a.d = b.d AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0 GROUP BY 1, 2),
r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
           AS "rank" FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 20""",
    "op7_warc_archive": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
m AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first_id
      FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM m""",
    "op11_line_first_rules": oracle.OP11_LINE_FIRST_RULES,
    "op12_fill_in_middle": oracle.OP12_FILL_IN_MIDDLE,
    "op13_lexical_rank": oracle.OP13_LEXICAL_RANK,
}
