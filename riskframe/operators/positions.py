"""Daily positions: a dense (portfolio, symbol, day) quantity series from deltas.

The reference builds pairs x calendar spine, left-joins the sparse daily
deltas and runs a cumulative sum. ``positions_daily`` computes the same rows
without ever shuffling the dense grid: the cumulative sum runs over the sparse
change points (one small shuffle after a map-side partial aggregation), and
each change point is then expanded map-side into the days it holds for.
The per-step operators (``cross_spine``, ``matrix``, ``running_quantity``) are
the literal building blocks, kept for callers that want them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import date_lit
from ..functions.windows import ordered, running

PAIR = ["portfolio_id", "symbol"]


def pairs(txns: DataFrame) -> DataFrame:
    """A4: every (symbol, portfolio) ever traded (partial aggregation, then one shuffle)."""
    return txns.select("symbol", "portfolio_id").distinct()


def start_date(txns: DataFrame, meta: DataFrame | None = None, source: str = "positions_daily") -> DataFrame:
    """A5: one-row frame [last_date] = watermark, else min(transaction_date) - 1."""
    first = txns.agg(F.date_sub(F.min("transaction_date"), 1).alias("first"))
    if meta is None:
        return first.select(F.col("first").alias("last_date"))
    wm = meta.filter(F.col("source") == source).agg(F.max("last_loaded_date")).scalar()
    return first.select(F.coalesce(wm, F.col("first")).alias("last_date"))


def _scalar(d) -> Column:
    if isinstance(d, DataFrame):
        return d.select(F.max(d.columns[0])).scalar()
    return date_lit(d)


def _as_of(as_of) -> Column:
    return F.current_date() if as_of is None else date_lit(as_of)


def window_rows(txns: DataFrame, after, as_of=None) -> DataFrame:
    """Transactions dated in (after, as_of]."""
    d = F.col("transaction_date")
    return txns.filter((d > _scalar(after)) & (d <= _as_of(as_of)))


def deltas(txns: DataFrame, after, as_of=None) -> DataFrame:
    """A3 + P6: net quantity change per (portfolio, symbol, day) in (after, as_of]."""
    a, t = _scalar(after), _as_of(as_of)
    return (txns.filter((F.col("transaction_date") > a) & (F.col("transaction_date") <= t))
            .groupBy("portfolio_id", "symbol", F.col("transaction_date").alias("date"))
            .agg(F.sum("quantity_delta").alias("qty_delta")))


def days_between(first: Column, last: Column) -> Column:
    """Array of days first..last; empty (never reversed) when first > last."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def date_spine(spark: SparkSession, last_date, as_of=None) -> DataFrame:
    """One row per calendar day in (last_date, as_of]; no upper cap on length."""
    anchor = last_date if isinstance(last_date, DataFrame) else spark.range(1).select(
        date_lit(last_date).alias("last_date"))
    ld = F.col(anchor.columns[0])
    return anchor.select(F.explode(days_between(F.date_add(ld, 1), _as_of(as_of))).alias("date"))


def priors(base: DataFrame, prior_positions: DataFrame | None, last_date) -> DataFrame:
    """Quantity of each pair at exactly last_date (0 when missing)."""
    if prior_positions is None:
        return base.select(*base.columns, F.lit(0.0).alias("prior_qty"))
    snap = (prior_positions.filter(F.col("date") == _scalar(last_date))
            .select("symbol", "portfolio_id", F.col("quantity").cast("double").alias("prior_qty")))
    return (base.join(snap, ["symbol", "portfolio_id"], "left")
            .select(*base.columns, F.coalesce("prior_qty", F.lit(0.0)).alias("prior_qty")))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt by pair over all shuffle partitions. A fixed number: the adaptive plan would pack
    the few bytes of the pairs into one task, which then generates the days of all of them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *PAIR)


def cross_spine(base: DataFrame, last_date, as_of=None) -> DataFrame:
    """Pairs x days in (last_date, as_of], generated map-side (no cartesian product)."""
    return spread(base).select(*base.columns,
                               F.explode(days_between(F.date_add(_scalar(last_date), 1), _as_of(as_of))).alias("date"))


def matrix(spined: DataFrame, daily: DataFrame) -> DataFrame:
    """Dense grid left-joined to daily deltas (one a pair and day), missing -> 0.

    Both sides are dealt by pair, so the join is a union in which a day's delta meets the
    day's row by sorting: the grid of ``cross_spine`` is not shuffled."""
    keys = [*PAIR, "date"]
    d = spread(daily.dropna(subset=keys).select(*keys, F.col("qty_delta").alias("_d")))
    rows = spined.withColumn("_day", F.lit(True)).unionByName(d, allowMissingColumns=True)
    found = rows.withColumn("_d", F.sum("_d").over(Window.partitionBy(*keys)))
    return found.filter("_day").select(*spined.columns, F.coalesce("_d", F.lit(0.0)).alias("qty_delta"))


def running_quantity(grid: DataFrame) -> DataFrame:
    """W5 (+J8 when ``grid`` carries prior_qty): prior + cumulative delta per pair."""
    prior = F.col("prior_qty") if "prior_qty" in grid.columns else F.lit(0.0)
    w = Window.partitionBy(*PAIR).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # the order of ``matrix``
    return grid.select("portfolio_id", "symbol", "date", (prior + F.sum("qty_delta").over(w)).alias("quantity"))


def positions_daily(txns: DataFrame, prior: DataFrame | None = None, last_date=None,
                    as_of=None, meta: DataFrame | None = None) -> DataFrame:
    """M2: dense positions for every traded pair and day in (last_date, as_of].

    ``last_date`` defaults to A5 (watermark in ``meta`` or the first
    transaction date - 1); ``prior`` is the existing positions table whose
    quantities at ``last_date`` seed the running sum.

    Plan: change points = one zero anchor per transaction row on the first
    day (so every traded pair starts there), the prior quantities on that day,
    and the transactions in (last_date, as_of]; one aggregation by
    (pair, day) with map-side partial aggregation, one window by pair, then a
    map-side explode of each change point over the days it holds for. Prior
    rows of pairs that never traded are dropped inside the same window (the
    reference's base is the distinct traded pairs), so no join is needed.
    """
    ld = _scalar(start_date(txns, meta) if last_date is None else last_date)
    t = _as_of(as_of)
    first_day = F.date_add(ld, 1)
    traded = txns.select(*PAIR, first_day.alias("date"), F.lit(0.0).alias("q"), F.lit(1).alias("traded"))
    moves = (txns.filter((F.col("transaction_date") > ld) & (F.col("transaction_date") <= t))
             .select(*PAIR, F.col("transaction_date").alias("date"),
                     F.col("quantity_delta").cast("double").alias("q"), F.lit(1).alias("traded")))
    points = traded.unionByName(moves)
    if prior is not None:
        seed = prior.filter(F.col("date") == ld).select(*PAIR, first_day.alias("date"),
                                                        F.col("quantity").cast("double").alias("q"),
                                                        F.lit(0).alias("traded"))
        points = points.unionByName(seed)
    points = spread(points.filter(first_day <= t).groupBy(*PAIR, "date")
                    .agg(F.sum("q").alias("q"), F.max("traded").alias("traded")))
    held = points.select(*PAIR, "date",
                         F.sum("q").over(running(PAIR)).alias("quantity"),
                         F.lead("date").over(ordered(PAIR)).alias("next_date"),
                         F.max("traded").over(Window.partitionBy(*PAIR)).alias("traded"))
    until = F.coalesce(F.date_sub(F.col("next_date"), 1), t)
    return (held.filter(F.col("traded") == 1)
            .select("portfolio_id", "symbol", F.explode(days_between(F.col("date"), until)).alias("date"),
                    "quantity"))
