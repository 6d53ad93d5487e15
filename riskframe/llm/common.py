"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import scratch_path

#: The bytes of ``[\\x20\\x09-\\x0D]``: what separates words and is stripped from lines.
SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the text ``null``)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % n


def whole_text(col: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(col, F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` under the shared folder and read it back.

    The files stay until the shared folder is cleaned, like checkpoints; a
    lost executor costs a re-read, never a recomputation of what went before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession, rows: int, per_task: int) -> int:
    """Groups for ``rows`` rows at ``per_task`` rows each, at least the session's shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
