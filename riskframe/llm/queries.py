"""Registered queries of the corpus operators: thin calls over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import fold, table
from riskframe.llm.decontam import find_leaks
from riskframe.llm.langid import fit_languages, identify
from riskframe.llm.linededup import dedup_lines
from riskframe.llm.lm import score_texts
from riskframe.llm.merkle import manifest
from riskframe.llm.mixing import mix_sources
from riskframe.llm.neardup import near_duplicates
from riskframe.llm.quality import fit_quality, score_quality
from riskframe.llm.repeats import drop_repeats
from riskframe.llm.spelling import group_variants
from riskframe.llm.topk import top_k
from riskframe.llm.toxicity import fit_toxicity, score_toxicity
from riskframe.llm.urls import judge_urls


def held_out(n: int, left: int) -> Column:
    return fold(F.col("doc_id"), n) == left


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    return (score_toxicity(docs, model)
            .select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "kept_sha256"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (score_texts(docs, ~held_out(7, 2))
            .select(F.col("id").alias("doc_id"), (fold(F.col("id"), 7) == 2).alias("held_out"),
                    "n_tokens", "n_known", "train_tokens", "base_score", "score"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return (score_quality(docs, model)
            .select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return (judge_urls(pages)
            .select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", "score"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mix_sources(docs)
            .select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "source"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs, ~held_out(4, 2))
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document (by crc32) is found without its line breaks."""
    found = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return (manifest(table(spark, sf_dir, "documents"), changed={"text": found})
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_near_dedup": op4_near_dedup,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_url_filter": op7_url_filter,
    "op8_top_k": op8_top_k,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_repeats": op12_repeats,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM parts
), common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT x.doc_id, x.pos, x.line, c.k IS NOT NULL AND x.doc_id <> c.keeper AS lost
  FROM keyed x LEFT JOIN common c ON x.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op8_top_k": r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
""",
}
