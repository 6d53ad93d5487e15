"""A folder of Parquet tables (RAW + ANALYTICS) addressed by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..sinks import tables as sink
from ..sources.files import table_exists
from . import changes


@dataclass
class Store:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return table_exists(self.spark, self.path(name))

    def read(self, name: str, where=None) -> DataFrame:
        """The table, or an empty frame of its schema when it does not exist yet.

        ``where`` may use the partition helper columns (``month``), so a filter
        such as ``month >= date_format(<watermark subquery>, 'yyyy-MM')`` prunes
        partitions at run time before the helpers are dropped.
        """
        t = schemas.TABLES[name]
        if not self.exists(name):
            return self.spark.createDataFrame([], t.schema)
        return sink.read_upserted(self.spark, self.path(name), t.schema, t.partition_by, where)

    def month_of(self, d) -> "Column":
        """The ``month`` partition value of a date (Column or literal)."""
        from pyspark.sql import functions as F
        from ..functions.columns import date_lit
        return F.date_format(date_lit(d), "yyyy-MM")

    def buckets(self, name: str) -> int:
        """Hash buckets for a key-bucketed table that is yet to be created:
        ``spark.riskframe.buckets.<table>`` from the session (size it to roughly
        table bytes / 1 GB), else the table's default. An existing table keeps the
        count stored with it."""
        return int(self.spark.conf.get(f"spark.riskframe.buckets.{name}", str(schemas.TABLES[name].buckets)))

    def upsert(self, name: str, updates: DataFrame, update_cols=None, insert_defaults=None, unique: bool = False,
               mostly_new: bool = False) -> DataFrame:
        """Merge by key; tables of ``changes.TRACKED`` hand on what changed, and of source tables only that
        is merged. ``unique``: for rows that a step computes from stored tables, one a key, and computes again
        when it ended early. ``mostly_new``: for computed rows that alter stored ones in few partitions."""
        t = schemas.TABLES[name]
        conformed = schemas.conform(updates, t.schema, insert_defaults)
        cols = [c for c in updates.columns if c in conformed.columns]

        tracked = changes.TRACKED.get(name)
        skim = None
        if tracked is not None and not tracked.compare:
            skim = mostly_new
        elif tracked is not None and not any(c.startswith("_") for c in (cols if update_cols is None else update_cols)):
            def skim(target, merging) -> DataFrame:
                return changes.differing(target, merging, t.keys, changes.image_columns(name), update_cols)

        def hand_on(target, merging, new, found=None) -> None:
            changes.record(self, name, target, merging, new, t.keys, update_cols, found)

        return sink.upsert_table(self.spark, self.path(name), conformed.select(*cols), t.keys, t.schema,
                                 t.partition_by, update_cols, insert_defaults, buckets=self.buckets(name),
                                 on_merge=hand_on if tracked else None, unique=unique, skim=skim)

    def append(self, name: str, df: DataFrame) -> int:
        t = schemas.TABLES[name]
        return sink.append(schemas.conform(df, t.schema), self.root, name)

    def ensure_tables(self) -> list[str]:
        """K7: create every missing table empty; never replace an existing one."""
        made = []
        for name, t in schemas.TABLES.items():
            if not self.exists(name):
                self.spark.createDataFrame([], t.schema).write.mode("ignore").parquet(self.path(name))
                made.append(name)
        return made
