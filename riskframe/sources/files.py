"""File and table scans (schema given, never inferred)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import parse_symbols, ts_lit
from ..schemas import QUERY_HISTORY, TRANSACTION_COLUMNS


DEFAULT_SYMBOLS = "AAPL,MSFT,GOOGL"   # fixed value: the universe when none is given


def _missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Parquet dataset ``root/name`` with a declared schema."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(f"{root}/{name}")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset folder exists (asked of its file system; nothing is read)."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, from its file system."""
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _hadoop(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a folder to a place that does not exist yet."""
    fs, p = _hadoop(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder, if it exists."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none when it does not exist."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of the files of a folder."""
    fs, p = _hadoop(spark, path)
    return [s.getLen() for s in fs.listStatus(p) if s.isFile()]


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Transactions CSV with header. Missing file -> FileNotFoundError;
    any of the six required columns missing -> ValueError. Columns are matched
    by header name (any order), then cast from text to their declared types;
    malformed values fail the job (ANSI)."""
    try:
        header = spark.read.option("header", True).csv(path).columns
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(f"CSV not found: {path}") from e
        raise
    missing = sorted(set(TRANSACTION_COLUMNS) - set(header))
    if missing:
        raise ValueError(f"Missing columns in CSV: {missing}")
    text = StructType([StructField(c, StringType()) for c in header])
    raw = spark.read.option("header", True).option("enforceSchema", False).schema(text).csv(path)
    return raw.select(F.col("transaction_id"), F.col("portfolio_id"), F.col("symbol"),
                      F.col("quantity_delta").cast("decimal(18,6)").alias("quantity_delta"),
                      F.to_date("transaction_date").alias("transaction_date"), F.col("transaction_type"))


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A query-history table (parquet or JSON lines) conformed to QUERY_HISTORY."""
    from ..schemas import conform
    if fmt == "json":
        return spark.read.schema(QUERY_HISTORY).json(path)
    return conform(spark.read.parquet(path), QUERY_HISTORY)


def history_window(history: DataFrame, as_of, hours: int = 1) -> DataFrame:
    """S8 filter: start_time in [as_of - hours, as_of]."""
    t = ts_lit(as_of)
    return history.filter((F.col("start_time") >= t - F.make_interval(hours=F.lit(hours)))
                          & (F.col("start_time") <= t))


def filter_universe(df: DataFrame, symbols=DEFAULT_SYMBOLS, col: str = "symbol") -> DataFrame:
    """Keep rows of a symbol universe.

    ``symbols``: comma-separated text or list (a literal IN list), or a
    DataFrame with a ``symbol`` column (left-semi join; the planner broadcasts
    it only when its measured size allows).
    """
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(F.col(symbols.columns[0]).alias(col)), col, "left_semi")
    names = parse_symbols(symbols) if isinstance(symbols, str) else [s for s in symbols if s]
    return df.filter(F.col(col).isin(names))
