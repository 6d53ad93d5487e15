"""Payload files -> RAW tables, new files found by a stream with ``trigger(availableNow=True)``.

The stream only answers "which files are new": it copies their documents to the
staging table, in a partition of this run (exactly once, by checkpoint and file sink). The
staged run is then loaded like any batch: rejects first (an error or a log entry), first arrival per key,
merge of the keys that are not stored yet, watermark. A run that ended
before its load is loaded by the next one, so overlapping, late or replayed files
neither duplicate nor lose rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..operators import clean as cl
from ..plans import incremental as inc
from ..plans import jobs
from ..plans.store import Store
from ..sources import payloads as pl
from ..sources.files import folder_names, write_text


@dataclass(frozen=True)
class Feed:
    key: str                      # payload column that names the entity
    series: str
    table: str
    parse: Callable[[DataFrame, str], DataFrame]
    clean: Callable[[DataFrame], DataFrame]


FEEDS = {
    "equities": Feed("symbol", pl.EQUITY_SERIES, "equity_daily", pl.parse_equity_payload, cl.clean_equities),
    "fx": Feed("pair", pl.FX_SERIES, "fx_daily", pl.parse_fx_payload, cl.clean_fx),
    "spy": Feed("symbol", pl.EQUITY_SERIES, "fact_benchmark", pl.parse_benchmark_payload,
                lambda d: cl.clean_equities(d, benchmark=True)),
}


def _schema(feed: Feed) -> StructType:
    return StructType([StructField(feed.key, StringType()), StructField("payload", StringType())])


def stage_new_files(spark: SparkSession, feed: Feed, source_path: str, stage: str, run: str, checkpoint: str,
                    fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
    """Copy the documents of every file not seen before, with the file's time as arrival, then stop."""
    reader = spark.readStream.schema(_schema(feed)).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.load(source_path).select(feed.key, "payload", F.col("_metadata.file_modification_time").alias(cl.ARRIVED),
                                           F.lit(run).alias("run"))
    (docs.writeStream.format("parquet").option("path", stage).option("checkpointLocation", checkpoint).partitionBy("run")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def load(store: Store, name: str, docs: DataFrame, start_date: str) -> None:
    feed = FEEDS[name]
    inc.load_feed(store, feed.parse(docs, start_date), feed.table, name, clean=feed.clean, late=True)


def ingest(store: Store, name: str, source_path: str, work: str, start_date: str = "0001-01-01",
           fmt: str = "parquet", max_files_per_trigger: int | None = None, on_reject: str = "fail") -> DataFrame:
    """Load the new payload files of a feed (``FEEDS``) into its RAW table; returns the table.

    ``work`` holds the checkpoint and the staged runs. A rejected document
    fails the call before its run is loaded and the run stays staged
    (``on_reject="fail"``), or is logged to ``pipeline_monitoring`` with its run
    and reason while the run's other documents are loaded (``"log"``); a good
    document of the same days that comes in a later file is merged like any other.
    A call that ends between the log and the load logs the run's rejects once more.
    """
    if on_reject not in ("fail", "log"):
        raise ValueError("on_reject must be 'fail' or 'log'")
    spark, feed, stage = store.spark, FEEDS[name], f"{work}/staged"
    runs = lambda: [n.partition("=")[2] for n in folder_names(spark, stage) if n.startswith("run=")]
    stage_new_files(spark, feed, source_path, stage, f"{len(runs()):06d}", f"{work}/checkpoint", fmt, max_files_per_trigger)
    loaded = set(folder_names(spark, f"{work}/loaded"))
    schema = StructType([*_schema(feed).fields, StructField(cl.ARRIVED, TimestampType()), StructField("run", StringType())])
    for staged in runs():
        if staged in loaded:
            continue
        docs = spark.read.schema(schema).parquet(stage).filter(F.col("run") == staged).drop("run")
        rejects = pl.payload_rejects(docs, feed.series, feed.key)
        if on_reject == "fail":
            with jobs.naming_rejects(rejects):     # judged as they are loaded
                load(store, name, pl.payload_required(docs, feed.series, feed.key), start_date)
        else:
            jobs.log_rejects(store, {name: rejects}, f"{name}-{staged}", F.current_date())
            load(store, name, pl.payload_accepted(docs, feed.series, feed.key), start_date)
        write_text(spark, f"{work}/loaded/{staged}", "")
    return store.read(feed.table)
