"""Parquet sinks and the merge (upsert) primitive.

Plain Parquet has no MERGE. ``upsert`` is a pure DataFrame function (full
outer join on the keys with per-side markers); ``upsert_table`` applies it to
a Parquet table by rewriting only the touched partitions with dynamic
partition overwrite. Every upserted table is partitioned either by columns
that are part of its key, or by a hash bucket of its key, so a key can never
move between partitions and the touched set is exactly the updates'.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..session import scratch_path
from ..sources.files import delete, file_sizes, folder_names, read_text, rename, table_exists, write_text

LAYOUT = "_layout.json"   # file inside a table (hidden from scans) that records how its rows are dealt
BUCKET = "_bucket"
DEFAULT_BUCKETS = 16   # of a new table; size to about table bytes / 1 GB
MOST_FILES, SMALL_FILE = 16, 32 << 20   # a partition that holds so many files, of fewer bytes on average, is packed again


def write_parquet(df: DataFrame, root: str, name: str, mode: str = "overwrite") -> str:
    """K1: one named dataset (static overwrite: never point it at its own input)."""
    path = f"{root}/{name}"
    df.write.mode(mode).parquet(path)
    return path


def write_partitioned(df: DataFrame, root: str, name: str, partition_cols) -> str:
    """K2: Hive-style ``col=val/`` tree; rows with a null partition key are
    dropped; only the partitions present in ``df`` are replaced (dynamic
    overwrite). A REBALANCE on the partition columns lets AQE split a hot
    partition value into several evenly sized files instead of one huge task.

    A new table is written to a hidden folder and published by one rename when
    the job has ended; into an existing one the driver moves partition by partition."""
    cols = list(partition_cols)
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
    out = df.filter(keep).hint("rebalance", *cols).write.mode("overwrite").partitionBy(*cols)
    path = f"{root}/{name}"
    if table_exists(df.sparkSession, path):
        out.option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        stage = f"{root}/_{name}-{uuid.uuid4().hex[:12]}"
        try:
            out.option("partitionOverwriteMode", "static").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(stage)
            rename(df.sparkSession, stage, path)
        finally:
            delete(df.sparkSession, stage)
    return path


def append(df: DataFrame, root: str, name: str) -> int:
    """K3 + D7: append rows; the row count comes from an Observation collected
    during the write itself (no second pass)."""
    obs = Observation(f"append_{name}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(f"{root}/{name}")
    return int(obs.get["rows"])


def present(key: str) -> Column:
    """A key column, whose nulls fail the job."""
    return F.when(F.col(key).isNull(), F.raise_error(F.lit(f"upsert: null key {key} in the updates"))).otherwise(F.col(key))


def upsert(target: DataFrame, updates: DataFrame, keys, update_cols=None, insert_defaults: dict | None = None,
           check_unique: bool = True) -> DataFrame:
    """K4 / K5: MERGE as a DataFrame.

    Matched keys: ``update_cols`` (default: every non-key column the updates
    carry) take the update's value, other columns keep the target's.
    Unmatched updates are inserted: columns the updates lack get
    ``insert_defaults[c]`` (a Column) or null. Target rows without an update
    stay as they are; nothing is deleted. A null key in ``updates`` makes the
    job fail, and so does a repeated one (one target row, two sources) when
    ``check_unique``. Copies of a key are counted by an aggregate, combined
    map-side, whose hash partitioning the merge join reuses: one exchange per
    side, and no task that gathers the copies of a hot key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    insert_defaults = insert_defaults or {}
    tcols = target.columns
    ucols = [c for c in updates.columns if c in tcols]
    update_cols = [c for c in (update_cols if update_cols is not None else ucols) if c not in keys]
    u = updates
    if check_unique:
        rest = [c for c in ucols if c not in keys]
        u = u.groupBy(*keys).agg(F.count(F.lit(1)).alias("_u_n"), F.first(F.struct(F.lit(True).alias("_"), *rest)).alias("_u_row"))
        u = u.select(*keys, *[F.col("_u_row").getField(c).alias(c) for c in rest], "_u_n")
    u = u.select(*[(present(c) if c in keys else F.col(c)).alias(f"_u_{c}") for c in ucols], F.lit(True).alias("_u"),
                 *(["_u_n"] if check_unique else []))
    t = target.select(*tcols, F.lit(True).alias("_t"))
    cond = None
    for k in keys:
        c = t[k] == u[f"_u_{k}"]
        cond = c if cond is None else cond & c
    j = t.join(u, cond, "full_outer")
    matched_u, has_t = F.col("_u").isNotNull(), F.col("_t").isNotNull()
    out = []
    for c in tcols:
        if c in keys:
            v = F.when(has_t, F.col(c)).otherwise(F.col(f"_u_{c}"))
        elif c in update_cols:
            v = F.when(matched_u, F.col(f"_u_{c}")).otherwise(F.col(c))
        else:
            ins = F.col(f"_u_{c}") if c in ucols else insert_defaults.get(c, F.lit(None))
            v = F.when(has_t, F.col(c)).otherwise(ins)
        if check_unique and c == keys[0]:
            # evaluated inside a kept column, so it cannot be pruned away
            v = F.when(F.coalesce(F.col("_u_n"), F.lit(0)) > 1,
                       F.raise_error(F.lit("upsert: a key appears more than once in the updates"))).otherwise(v)
        out.append(v.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def bucket_of(keys, buckets: int = DEFAULT_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


# Partition columns derived from a key column (so a key never changes partition).
DERIVED = {
    "month": lambda: F.date_format(F.col("date"), "yyyy-MM"),
}


def inserted(updates: DataFrame, keys, schema: StructType, insert_defaults: dict | None = None) -> DataFrame:
    """What ``upsert`` makes of updates whose keys the target does not hold. A null key fails the job."""
    insert_defaults = insert_defaults or {}

    def value(f: StructField) -> Column:
        if f.name not in updates.columns:
            return insert_defaults.get(f.name, F.lit(None))
        if f.name not in keys:
            return F.col(f.name)
        return present(f.name)
    return updates.select(*[value(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def fail_on_repeated_keys(updates: DataFrame, keys) -> None:
    """Counts per key, combined map-side: only keys are shuffled, and no task gathers the copies of a hot one.
    Null keys are left to the merge, which refuses them."""
    if not updates.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).isEmpty():
        raise ValueError("upsert: a key appears more than once in the updates")


def stored_values(spark: SparkSession, path: str, pcol: str) -> set[str]:
    """Values of the first partition column that the table at ``path`` holds, from its folder names."""
    return {unquote(n.partition("=")[2]) for n in folder_names(spark, path) if n.startswith(f"{pcol}=")}


def dealt(spark: SparkSession, path: str, updates: DataFrame, keys, pcols: list, buckets: int) -> DataFrame:
    """The updates with the partition columns of the table at ``path``."""
    buckets = settled_layout(spark, path, pcols, buckets)
    for c in pcols:
        if c == BUCKET:
            updates = updates.withColumn(BUCKET, bucket_of(keys, buckets))
        elif c in DERIVED:
            updates = updates.withColumn(c, DERIVED[c]())
        elif c not in keys:
            raise ValueError(f"partition column {c} must be a key or derived from one")
    return updates


def written(df: DataFrame, name: str) -> DataFrame:
    """A frame written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_updates(spark: SparkSession, updates: DataFrame, pcols: list, whole: StructType, stored: set) -> tuple[DataFrame, list, list]:
    """The updates written once, the partition values in them, and those of them that the table holds."""
    staged = written(updates, "merge")
    touched = [tuple(r) for r in staged.select(*pcols).distinct().collect()]
    plain = whole[pcols[0]].dataType in (IntegerType(), StringType())      # else a value may differ from its folder's name
    return staged, touched, [v for v in touched if stored and (not plain or str(v[0]) in stored)]


def merge_plan(spark: SparkSession, path: str, updates: DataFrame, keys, schema: StructType, partition_by=(),
               update_cols=None, insert_defaults: dict | None = None,
               buckets: int = DEFAULT_BUCKETS, on_merge=None, unique: bool = False) -> tuple[DataFrame, list]:
    """The merged rows of the touched partitions (and the partition columns) that
    ``upsert_table`` writes. The updates are written once to the shared folder,
    so their plan runs once; their distinct partition values (one row per
    partition touched) then filter the target as literals: only those
    partitions are listed and read, whatever the updates' plan or size. Rows of a
    partition that is not stored yet have nothing to merge with and join nothing.
    ``on_merge(target, updates, new)`` sees the target, the updates of stored partitions and those of
    new ones (None: no rows) before anything is written.

    Updates whose keys cannot repeat (``unique``) are not searched for copies, and for
    a table that holds no rows yet they need no staging: their own plan is
    what is written (``on_merge`` is not called then, see ``upsert_table``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    pcols = list(partition_by) or [BUCKET]
    updates = dealt(spark, path, updates, keys, pcols, buckets)
    whole = stored_schema(schema, pcols)
    stored = stored_values(spark, path, pcols[0])
    if unique and not stored:
        return inserted(updates, keys, whole, insert_defaults), pcols
    staged, touched, old = staged_updates(spark, updates, pcols, whole, stored)
    target = spark.read.schema(whole).parquet(path).filter(_in_partitions(pcols, old))
    if not unique:
        fail_on_repeated_keys(staged, keys)
    if not old:
        both, merging, new = None, None, staged
    elif len(old) == len(touched):
        both, merging, new = target, staged, None
    else:
        both, merging, new = target, staged.filter(_in_partitions(pcols, old)), staged.filter(_in_partitions(pcols, sorted(set(touched) - set(old), key=str)))
    if on_merge is not None:
        on_merge(both, merging, new)
    parts = [] if merging is None else [upsert(target, merging, keys, update_cols, insert_defaults, check_unique=False)]
    parts += [] if new is None else [inserted(new, keys, whole, insert_defaults)]
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])), pcols


def _in_partitions(pcols: list, values: list[tuple]) -> Column:
    """The partitions with these values; null-safe, as literals."""
    if len(pcols) == 1:
        some = [v for v, in values if v is not None]
        cond = F.col(pcols[0]).isin(some) if some else F.lit(False)
        return cond | F.col(pcols[0]).isNull() if len(some) < len(values) else cond
    cond = F.lit(False)
    for row in values:
        one = F.lit(True)
        for c, v in zip(pcols, row):
            one = one & F.col(c).eqNullSafe(F.lit(v))
        cond = cond | one
    return cond


def settled_layout(spark: SparkSession, path: str, pcols: list, buckets: int) -> int:
    """The bucket count of the table at ``path``: the stored one, or ``buckets`` stored now for a new table.

    How rows are dealt is part of the table: other partition columns than the
    stored ones are an error, and a setting cannot change the bucket count.
    """
    place = f"{path}/{LAYOUT}"
    if table_exists(spark, place):
        known = json.loads(read_text(spark, place))
        if known["partition_by"] != list(pcols):
            raise ValueError(f"{path} is partitioned by {known['partition_by']}, not {list(pcols)}")
        return known["buckets"]
    write_text(spark, place, json.dumps({"partition_by": list(pcols), "buckets": int(buckets)}))
    return int(buckets)


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys, schema: StructType,
                 partition_by=(), update_cols=None, insert_defaults: dict | None = None,
                 buckets: int = DEFAULT_BUCKETS, on_merge=None, unique: bool = False, skim=None) -> DataFrame:
    """K4 applied to a Parquet table at ``path`` (created on first use).

    ``partition_by``: key columns, names in ``DERIVED`` (e.g. ``month`` of the
    date key) or, when empty, a hash bucket of the key. Reads only the
    partitions the updates touch, merges on the keys (hash-partitioned by the
    keys, so a daily increment that lands in one partition still spreads over
    every task), then rebalances by partition value before the write: AQE
    packs each value into one file, or splits a large one into several.
    Dynamic overwrite replaces exactly the touched partitions through the
    commit protocol's staging folder, so a lost executor re-runs tasks, not
    the job. Re-running the same batch is a no-op on content.

    ``unique``: the updates hold no key twice by the way they are made, and are made
    again if a run ends early; ``on_merge`` then sees the first rows of a
    table after they are written, not before.

    ``skim``: what need not be written is left out, for a table with one partition column of text or
    whole numbers. With a function of (target, updates) that keeps the updates which insert or alter
    a row (``changes.differing``) only these are merged; with True all are, but partitions in which
    none of them is stored yet get new files beside their old ones (see ``append_and_merge``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    pcols = list(partition_by) or [BUCKET]
    stored = stored_values(spark, path, pcols[0])
    if skim and stored:
        append_and_merge(spark, path, updates, keys, schema, pcols, update_cols, insert_defaults, buckets, on_merge, unique, skim)
        return read_upserted(spark, path, schema, pcols)
    direct = unique and not stored
    merged, pcols = merge_plan(spark, path, updates, keys, schema, partition_by, update_cols, insert_defaults,
                               buckets, on_merge, unique)
    write_partitions(merged, path, pcols, "overwrite")
    out = read_upserted(spark, path, schema, pcols)
    if direct and on_merge is not None:
        on_merge(None, None, out)
    return out


def write_partitions(rows: DataFrame, path: str, pcols: list, mode: str) -> None:
    """Rows packed by partition value; "overwrite" replaces the partitions present, "append" adds files to them."""
    (rows.hint("rebalance", *pcols).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*pcols).parquet(path))


def append_and_merge(spark: SparkSession, path: str, updates: DataFrame, keys: list, schema: StructType, pcols: list,
                     update_cols, insert_defaults, buckets: int, on_merge, unique: bool, skim) -> None:
    """A merge that writes what it must into a table that holds rows: a partition is read and written
    again when a stored row of it is altered, or when it holds ``MOST_FILES`` small files already; rows that are
    new to the other partitions are appended. Which keys are stored comes from one join, of the keys
    alone or (``skim`` a function) of the compared columns, before anything is written.
    A run that ends between the two writes leaves whole rows, which the next one finds stored."""
    updates = dealt(spark, path, updates, keys, pcols, buckets).withColumns({k: present(k) for k in keys})
    whole = stored_schema(schema, pcols)
    staged, touched, old = staged_updates(spark, updates, pcols, whole, stored_values(spark, path, pcols[0]))
    if not touched:     # no rows
        return
    if not unique:
        fail_on_repeated_keys(staged, keys)
    target = spark.read.schema(whole).parquet(path)
    both, merging, new = target.filter(_in_partitions(pcols, old)), None, staged
    if old:
        merging, new = staged.filter(_in_partitions(pcols, old)), None
        if len(old) < len(touched):
            new = staged.filter(_in_partitions(pcols, sorted(set(touched) - set(old), key=str)))
    rows, hit = staged, []
    if callable(skim):
        found = None if merging is None else written(skim(both, merging), "changed")
        if on_merge is not None:
            on_merge(None, None, new, found)
        if found is not None:
            seen = found.groupBy(*pcols).agg(F.bool_or("_stored").alias("hit")).collect()      # one row a partition
            touched = sorted(set(touched) - set(old) | {(r[0],) for r in seen}, key=str)
            hit = [(r[0],) for r in seen if r.hit]
            rows = found.select(*updates.columns) if new is None else found.select(*updates.columns).unionByName(new)
    else:
        if on_merge is not None:
            on_merge(both if old else None, merging, new)
        if old:
            hit = [tuple(r) for r in both.join(merging.select(*keys), keys, "left_semi").select(*pcols).distinct().collect()]
    crowded = crowded_partitions(spark, path, pcols[0], {v for v, in touched if (v,) in old})
    again = [v for v in touched if v in hit or v in crowded]
    if len(again) < len(touched):
        some = rows.filter(_in_partitions(pcols, sorted(set(touched) - set(again), key=str))) if again else rows
        write_partitions(inserted(some, keys, whole, insert_defaults), path, pcols, "append")
    if again:
        here = _in_partitions(pcols, again)
        write_partitions(upsert(target.filter(here), rows.filter(here), keys, update_cols, insert_defaults, check_unique=False),
                         path, pcols, "overwrite")


def crowded_partitions(spark: SparkSession, path: str, pcol: str, values: set) -> list:
    """Those of the partitions that hold ``MOST_FILES`` small files: the next merge packs them again."""
    places = {unquote(n.partition("=")[2]): n for n in folder_names(spark, path) if n.startswith(f"{pcol}=")}
    crowded = []
    for v in values:
        sizes = file_sizes(spark, f"{path}/{places[str(v)]}")
        if len(sizes) >= MOST_FILES and sum(sizes) < len(sizes) * SMALL_FILE:
            crowded.append((v,))
    return crowded


def stored_schema(schema: StructType, partition_by=()) -> StructType:
    """The table schema plus its partition helper columns (month text / key bucket)."""
    pcols = list(partition_by) or [BUCKET]
    extra = [StructField(c, IntegerType() if c == BUCKET else StringType()) for c in pcols if c not in schema.names]
    return StructType(schema.fields + extra)


def read_upserted(spark: SparkSession, path: str, schema: StructType, partition_by=(), where=None) -> DataFrame:
    """Read a table written by ``upsert_table`` with its declared schema (no
    footer inference); ``where`` may filter on the partition helper columns
    (pruning), which are then dropped."""
    df = spark.read.schema(stored_schema(schema, partition_by)).parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*schema.names)
