"""Change sets: from which day on an entity's rows were inserted or altered.

Before a merge into a tracked table is written (after it, for the first rows of a table
that a step computes), one batch of (entity, since)
rows is stored under ``changes/log/<table>``: the earliest day among the rows
that differ from the table (source tables, old and new image of each row) or
among the rows merged (tables that are themselves recomputed by suffix).
Each table derived from it reads the batches it has not used yet, computes
the named suffixes again, merges them and only then marks the batches as used. A run
that fails in between leaves a batch to be used once more, which computes the
same rows again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..sinks.tables import written
from ..sources.files import folder_names, write_text

EVER = "0001-01-01"   # since of an entity without a day column: all of its rows


@dataclass(frozen=True)
class Tracked:
    entity: tuple
    day: str | None
    compare: bool      # store only what differs from the table


TRACKED = {
    "equity_daily": Tracked(("symbol",), "date", True),
    "fx_daily": Tracked(("pair",), "date", True),
    "dim_symbol": Tracked(("symbol",), None, True),
    "portfolio_transactions": Tracked(("portfolio_id", "symbol"), "transaction_date", True),
    "fact_prices": Tracked(("symbol",), "date", False),
    "portfolio_positions_daily": Tracked(("portfolio_id", "symbol"), "date", False),
    "portfolio_daily": Tracked(("portfolio_id",), "date", False),
    "fact_portfolio_metrics": Tracked(("portfolio_id",), "date", False),
    "fact_benchmark": Tracked(("symbol",), "date", True),
}
READS = {
    "fact_prices": ("equity_daily", "fx_daily", "dim_symbol"),
    "portfolio_positions_daily": ("portfolio_transactions",),
    "portfolio_daily": ("fact_prices", "portfolio_positions_daily"),
    "fact_portfolio_metrics": ("portfolio_daily",),
    "fact_portfolio_adv_metrics": ("fact_portfolio_metrics", "fact_benchmark"),
}


def differing(target: DataFrame, updates: DataFrame, keys, columns, update_cols=None) -> DataFrame:
    """The updates that insert or alter a row, with ``_stored`` and the stored values of ``columns`` and of the
    compared ones as ``_old_``. Columns that start with ``_`` are book-keeping."""
    shared = [c for c in updates.columns if c in target.columns]
    compared = [c for c in (shared if update_cols is None else update_cols) if c not in keys and not c.startswith("_")]
    old = {c: f"_old_{c}" for c in dict.fromkeys([*keys, *compared, *columns])}
    t = target.select(*[F.col(c).alias(o) for c, o in old.items()], F.lit(True).alias("_stored"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(old[k]))
    differs = F.col("_stored").isNull()
    for c in compared:
        differs = differs | ~F.col(c).eqNullSafe(F.col(old[c]))
    return updates.join(t, cond, "left").filter(differs).withColumn("_stored", F.col("_stored").isNotNull())


def images(target: DataFrame, updates: DataFrame, keys, columns, update_cols=None) -> DataFrame:
    """``columns`` of the rows that a merge inserts or alters: as they will be, and (altered rows) as they are."""
    return images_of(differing(target, updates, keys, columns, update_cols), keys, columns, update_cols)


def images_of(found: DataFrame, keys, columns, update_cols=None) -> DataFrame:
    """``images`` of ``differing`` rows."""
    shared = [c for c in found.columns if not c.startswith("_old_")]
    updated = shared if update_cols is None else update_cols
    stored = F.col("_stored")

    def value(c: str) -> Column:
        """What the merge will hold: columns that are not updated keep the stored value."""
        if c in keys or c in updated and not c.startswith("_"):
            return F.col(c)
        return F.when(stored, F.col(f"_old_{c}")).otherwise(F.col(c) if c in shared else F.lit(None))

    after = F.struct(*[value(c).alias(c) for c in columns])
    before = F.struct(*[F.col(f"_old_{c}").alias(c) for c in columns])
    return found.select(F.inline(F.array_compact(F.array(after, F.when(stored, before)))))


def image_columns(table: str) -> list[str]:
    t = TRACKED[table]
    return [*t.entity, *([t.day] if t.day else [])]


def record(store, table: str, target: DataFrame | None, updates: DataFrame | None, new: DataFrame | None, keys, update_cols=None,
           found: DataFrame | None = None) -> None:
    """Store the change set of a merge: ``updates`` beside the ``target`` rows of their partitions (or what is
    ``differing`` in them, if that is known), and ``new`` rows of partitions that hold nothing yet, which all count."""
    t = TRACKED[table]
    columns = image_columns(table)
    rows = updates
    if found is not None:
        rows = images_of(found, keys, columns, update_cols)
    elif updates is not None:
        rows = images(target, updates, keys, columns, update_cols) if t.compare else updates.select(*columns)
    if new is not None:
        first = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(StringType() if c != t.day else DateType()).alias(c)
                             for c in columns])
        rows = first if rows is None else rows.unionByName(first)
    since = F.min(t.day) if t.day else F.to_date(F.lit(EVER))
    (rows.groupBy(*t.entity).agg(since.alias("since"))
     .write.parquet(f"{store.root}/changes/log/{table}/{uuid.uuid4().hex}"))


@dataclass
class Pending:
    """The change sets that a derived table has not used yet."""
    store: object
    reader: str
    batches: dict

    def since(self, table: str) -> DataFrame:
        """(entity, since) rows, one per entity; no rows when nothing changed."""
        entity = TRACKED[table].entity
        schema = StructType([*(StructField(c, StringType()) for c in entity), StructField("since", DateType())])
        paths = [f"{self.store.root}/changes/log/{table}/{b}" for b in self.batches[table]]
        spark = self.store.spark
        rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return rows.groupBy(*entity).agg(F.min("since").alias("since"))

    def done(self) -> None:
        for table, names in self.batches.items():
            for b in names:
                write_text(self.store.spark, f"{self.store.root}/changes/used/{self.reader}/{table}/{b}", "")


def pending(store, reader: str) -> Pending:
    def names(table: str) -> list[str]:
        used = set(folder_names(store.spark, f"{store.root}/changes/used/{reader}/{table}"))
        return [b for b in folder_names(store.spark, f"{store.root}/changes/log/{table}") if b not in used]
    return Pending(store, reader, {table: names(table) for table in READS[reader]})


def kept(store, df: DataFrame) -> DataFrame:
    """A small frame written to the shared folder and read back: computed once, its size known."""
    return written(df, "late")


def earlier(store, since: DataFrame, start: Column) -> tuple[DataFrame, Column]:
    """The entities whose changes begin before ``start`` (one row each, none on
    an ordinary day), and the first day to compute for any entity, as a scalar."""
    late = kept(store, since.filter(F.col("since") < start))
    return late, F.least(start, late.agg(F.min("since")).scalar())


def from_first(df: DataFrame, late: DataFrame, start: Column, name: str = "_from") -> DataFrame:
    """``df`` with the first day to compute for each row's entity."""
    keys = [c for c in late.columns if c != "since"]
    return df.join(late, keys, "left").withColumn(name, F.coalesce("since", start)).drop("since")
