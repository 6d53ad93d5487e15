"""Price fact: equity x FX x symbol dimension, with per-symbol rolling stats.

Plan shape: the FX side is one pair (one row per date) and is small enough for
the planner's size-checked broadcast; the dimension join and the per-symbol
window share one hash partitioning on ``symbol``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_lit
from ..functions.windows import ordered, trailing_rows

LONGEST_FRAME = 30   # rows of the longest price window
PRICE_COLUMNS = ["symbol", "date", "company_name", "currency", "open", "high", "low", "close", "volume",
                 "usd_to_gbp", "close_gbp", "daily_return", "rolling_7d_avg_close", "rolling_30d_volatility"]


def join_fx(equity: DataFrame, fx: DataFrame, pair: str = "USDGBP") -> DataFrame:
    """J1 + P3: inner join on date with one FX pair; dates without a rate drop out."""
    rates = fx.filter(F.col("pair") == pair).select("date", F.col("rate").alias("usd_to_gbp"))
    return equity.join(rates, "date")


def join_dim(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Company name / currency; unknown symbols keep nulls."""
    return df.join(dim.select("symbol", "company_name", "currency"), "symbol", "left")


def project(df: DataFrame) -> DataFrame:
    """Base columns plus close in GBP."""
    return df.select("symbol", "date", "company_name", "currency", "open", "high", "low", "close", "volume",
                     "usd_to_gbp", (F.col("close") * F.col("usd_to_gbp")).alias("close_gbp"))


def with_window_stats(df: DataFrame, price: str = "close", avg_rows: int = 7, vol_rows: int = LONGEST_FRAME,
                      entity: str = "symbol") -> DataFrame:
    """Return vs previous trading row, rolling mean, rolling stddev of levels."""
    w = ordered(entity)
    p = F.col(price)
    return df.select(
        "*",
        (F.try_divide(p, F.lag(p).over(w)) - 1).alias("daily_return"),
        F.avg(p).over(trailing_rows(entity, avg_rows)).alias("rolling_7d_avg_close"),
        F.stddev_samp(p).over(trailing_rows(entity, vol_rows)).alias("rolling_30d_volatility"))


def _after(after, default_start) -> Column:
    if after is None:
        return date_lit(default_start)
    if isinstance(after, DataFrame):          # one-row watermark frame -> scalar subquery
        return after.select(F.coalesce(F.max(after.columns[0]), date_lit(default_start))).scalar()
    return date_lit(after)


def short_history_symbols(priced_recent: DataFrame, after: Column, lookback_rows: int) -> DataFrame:
    """Symbols with rows after ``after`` but fewer than ``lookback_rows`` rows
    in ``priced_recent`` up to ``after``: the only ones whose windows need
    history older than the recent span."""
    have = priced_recent.filter(F.col("date") <= after).groupBy("symbol").agg(F.count("*").alias("n"))
    return (priced_recent.filter(F.col("date") > after).select("symbol").distinct()
            .join(have, "symbol", "left").filter(F.coalesce(F.col("n"), F.lit(0)) < lookback_rows)
            .select("symbol"))


def _history_for(priced: DataFrame, after: Column, lookback_rows: int, lookback_days: int) -> DataFrame:
    """Rows needed to compute the windows of dates > after, exactly.

    Recent rows (date > after - lookback_days) always; older rows only for the
    ``short_history_symbols``, through a semi-join. ``priced`` must already be
    FX-joined: windows count rows that survive it.
    """
    cut = F.date_sub(after, lookback_days)
    recent = priced.filter(F.col("date") > cut)
    need = short_history_symbols(recent, after, lookback_rows)
    older = priced.filter(F.col("date") <= cut).join(need, "symbol", "left_semi")
    return recent.unionByName(older)


def fact_prices(equity: DataFrame, fx: DataFrame, dim: DataFrame, after=None, pair: str = "USDGBP",
                history: str = "window", default_start: str = "2025-01-01",
                lookback_days: int | None = None, avg_rows: int = 7, vol_rows: int = LONGEST_FRAME) -> DataFrame:
    """M1: FACT_PRICES rows for dates > watermark.

    ``after``: None (use ``default_start``), a date, a Column, or a one-row
    watermark DataFrame (run as a scalar subquery, so the date filter still
    reaches the Parquet scan).

    ``history='increment'`` filters before the windows (the first new row of
    each symbol gets a null return); ``'window'`` computes the windows over
    history and keeps only new rows. With ``lookback_days`` the history scan is
    bounded but exact (symbols with too little recent history fall back to
    their full history).
    """
    cut = _after(after, default_start)
    if history == "increment":
        base = join_fx(equity.filter(F.col("date") > cut), fx, pair)
    elif history == "window":
        base = join_fx(equity, fx, pair)
        if lookback_days is not None:
            base = _history_for(base, cut, max(avg_rows, vol_rows), lookback_days)
    else:
        raise ValueError("history must be 'window' or 'increment'")
    joined = project(join_dim(base, dim))
    out = with_window_stats(joined, "close", avg_rows, vol_rows)
    if history == "window":
        out = out.filter(F.col("date") > cut)
    return out.select(*PRICE_COLUMNS)
