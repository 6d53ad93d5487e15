"""Cleaning and mixing a corpus: five stages, each a whole-table operator of ``riskframe.llm``.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps,
with the columns it was given (the last returns the mix); ``run`` writes each
stage's result to the shared folder and hands the stored table to the next.

Nulls: a null text is empty; a null doc_id is kept as it is (near-duplicates
tell such rows apart by their text). Rows that repeat a doc_id are documents of
their own; in near-dedup only those that repeat the text, too, are one (of a
class, ids that hold one text come before ids that hold several).
Empty tables give empty results; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import fold, stored, table, whole_text
from riskframe.llm.decontam import find_leaks
from riskframe.llm.linededup import dedup_lines
from riskframe.llm.mixing import mix_sources
from riskframe.llm.neardup import near_duplicates, row_ident
from riskframe.llm.toxicity import fit_toxicity, score_toxicity


def as_row(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), F.col("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window scores below 0.5."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return score_toxicity(as_row(docs), model).filter("score < 0.5").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others keep."""
    kept = dedup_lines(docs)
    columns = [F.col("kept_text").alias(c) if c == "text" else
               F.length("kept_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c)
               for c in docs.columns]
    return kept.select(*columns)


def identified(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``), text, ident: the doc_id, or for an id that holds several texts a hash of both
    above 2 ** 62. These ids are stored first: their size is known when the planner chooses the join."""
    text = F.xxhash64(whole_text(F.col("text")))
    several = stored(docs.groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high"))
                     .filter("low <> high").select(F.col("doc_id").alias("several")), "pipeline-ids")
    mix_of_both = F.shiftrightunsigned(F.xxhash64("doc_id", whole_text(F.col("text"))), 2).bitwiseOR(F.lit(1 << 62))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    return rows.join(several, F.col("doc_id") == F.col("several"), "left").select(
        "row", "text", F.when(F.col("several").isNotNull(), mix_of_both).otherwise(row_ident(F.col("doc_id"), F.col("text"))).alias("ident"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id."""
    rows = identified(docs)
    keep = near_duplicates(rows, id_col="ident").filter("id = class_id").select(F.col("id").alias("ident")).distinct()
    first = Window.partitionBy("ident").orderBy(F.col("row.text").asc_nulls_first(), F.xxhash64("row"))
    return (rows.join(keep, "ident", "left_semi").withColumn("place", F.row_number().over(first))
            .filter("place = 1").select("row.*"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).filter(F.size("leaks") == 0).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document left."""
    return mix_sources(docs).select(F.col("row.doc_id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]

#: Trained networks, similarity classes and seeded selection have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
