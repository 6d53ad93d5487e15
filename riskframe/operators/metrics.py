"""Portfolio metrics view: holdings -> daily totals -> rolling volatility and VaR."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import trailing_days, trailing_rows

METRIC_COLUMNS = ["portfolio_id", "date", "total_value_gbp", "weighted_daily_return",
                  "rolling_30d_volatility", "daily_var_95"]


def holdings(prices: DataFrame, positions: DataFrame) -> DataFrame:
    """J3 + P2: price rows x position rows on (symbol, date); non-trading days vanish.

    The positions side can be generated by ``explode`` (pairs x days), which the
    planner's static size estimate does not see; the MERGE hint keeps it from
    being broadcast on that estimate. A hinted join stays a sort-merge join."""
    p = prices.select("symbol", "date", F.col("close_gbp").cast("double").alias("close_gbp"),
                      F.col("daily_return").cast("double").alias("daily_return"))
    q = positions.select("portfolio_id", "symbol", "date", F.col("quantity").cast("double").alias("quantity"))
    return (p.join(q.hint("merge"), ["symbol", "date"])
            .select("portfolio_id", "date", "symbol", "close_gbp", "daily_return", "quantity",
                    (F.col("close_gbp") * F.col("quantity")).alias("position_value_gbp")))


def daily(h: DataFrame) -> DataFrame:
    """A1 + A2: total value and value-weighted return per (portfolio, date).

    Null returns drop out of the numerator but their value stays in the
    denominator; a zero total gives a null return.
    """
    v, r = F.col("position_value_gbp"), F.col("daily_return")
    return (h.groupBy("portfolio_id", "date")
            .agg(F.sum(v).alias("total_value_gbp"),
                 (F.sum(r * v) / F.nullif(F.sum(v), F.lit(0.0))).alias("weighted_daily_return")))


def with_volatility(d: DataFrame, rows: int = 30, col: str = "weighted_daily_return") -> DataFrame:
    """Sample stddev of the return over the last ``rows`` rows."""
    return d.select("*", F.stddev_samp(col).over(trailing_rows("portfolio_id", rows)).alias("rolling_30d_volatility"))


def rolling_var(d: DataFrame, days: int = 30, q: float = 0.05, col: str = "weighted_daily_return") -> DataFrame:
    """Exact ``q`` percentile (linear interpolation, nulls ignored) of the
    return over the calendar days [d - (days-1), d]. A RANGE frame replaces the
    correlated band self-join: one exchange, no join."""
    return d.select("*", F.percentile(F.col(col), F.lit(q)).over(trailing_days("portfolio_id", days))
                    .alias("daily_var_95"))


def portfolio_metrics(prices: DataFrame, positions: DataFrame, vol_rows: int = 30, var_days: int = 30,
                      q: float = 0.05) -> DataFrame:
    """M3 (flagship): VIEW_PORTFOLIO_METRICS. Both windows share one partitioning
    and ordering, so they run in a single Window operator after one exchange."""
    return over_days(daily(holdings(prices, positions)), vol_rows, var_days, q)


def over_days(d: DataFrame, vol_rows: int = 30, var_days: int = 30, q: float = 0.05) -> DataFrame:
    """The two rolling columns over the daily aggregate."""
    r = F.col("weighted_daily_return")
    return d.select(
        "portfolio_id", "date", "total_value_gbp", "weighted_daily_return",
        F.stddev_samp(r).over(trailing_rows("portfolio_id", vol_rows)).alias("rolling_30d_volatility"),
        F.percentile(r, F.lit(q)).over(trailing_days("portfolio_id", var_days)).alias("daily_var_95"))


def register_view(spark: SparkSession, prices: DataFrame, positions: DataFrame,
                  name: str = "view_portfolio_metrics") -> DataFrame:
    """K6: CREATE OR REPLACE VIEW equivalent (session temp view)."""
    df = portfolio_metrics(prices, positions)
    df.createOrReplaceTempView(name)
    return spark.table(name)
