"""Cleaning: null drops, numeric coercion, first-row-per-key dedupe, feed unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col_of, normalise_key, to_number


ARRIVED = "_arrived"   # optional column of a feed: when the row's document arrived


def dedupe_first(df: DataFrame, keys, order_by=None) -> DataFrame:
    """Keep the first row per key under ``order_by`` (ascending, nulls first;
    default: the arrival when the frame carries one, then the remaining columns
    in order, which makes the survivor unique).

    Planned as an aggregate, ``min(struct(order..., row))`` per key (by default the row is the order): map-side
    partial aggregation collapses duplicates before the shuffle, so a hot key
    costs one row per map task, not one task holding all its copies.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = sorted((c for c in df.columns if c not in keys), key=lambda c: c != ARRIVED)
    if order_by is None and others:     # the remaining columns are both the order and the row: carried once
        first = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_first"))
        return first.select(*keys, *[F.col("_first").getField(c).alias(c) for c in others]).select(*df.columns)
    order = [col_of(c) for c in (order_by if order_by is not None else others)]
    if isinstance(order_by, (str, Column)):
        order = [col_of(order_by)]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                      F.struct(*[F.col(c) for c in others]).alias("_row"))
    first = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return first.select(*[F.col(k) for k in keys], *[F.col("_first._row").getField(c).alias(c) for c in others]) \
        .select(*df.columns)


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name."""
    return df.toDF(*[c.upper() for c in df.columns])


def clean_equities(df: DataFrame, benchmark: bool = False, order_by=None) -> DataFrame:
    """Drop rows null in symbol/date/close; volume to a number with bad or
    missing values as 0 (not for the benchmark feed); first row per (symbol, date).
    Nulls in open/high/low are kept."""
    out = df.dropna(subset=["symbol", "date", "close"])
    if not benchmark and "volume" in out.columns:
        out = out.withColumn("volume", to_number("volume", fill=0, dtype="double"))
    return dedupe_first(out, ["symbol", "date"], order_by)


def clean_fx(df: DataFrame, order_by=None) -> DataFrame:
    """Drop null pair/date/rate; date to date type; rate numeric, bad -> dropped;
    first row per (pair, date)."""
    out = df.dropna(subset=["pair", "date", "rate"])
    out = out.withColumn("date", F.to_date(F.col("date").cast("string")))
    out = out.withColumn("rate", to_number("rate")).dropna(subset=["rate"])
    return dedupe_first(out, ["pair", "date"], order_by)


def normalise_keys(df: DataFrame, *cols: str) -> DataFrame:
    """C7 on whole columns."""
    return df.withColumns({c: normalise_key(c) for c in cols})


def union_feeds(*feeds: DataFrame, keys=("symbol", "date")) -> DataFrame:
    """UNION ALL of per-symbol frames, then the first row per key, where
    'first' means the earlier feed (then the row's own values)."""
    tagged = [f.withColumn("_feed", F.lit(i)) for i, f in enumerate(feeds)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    cols = [c for c in u.columns if c != "_feed"]
    return dedupe_first(u, list(keys), ["_feed"] + [c for c in cols if c not in keys]).drop("_feed")
