"""Risk metrics: Sharpe, Sortino, drawdown, beta, alpha over 30-row windows.

The reference joins four sets derived from one base back together. Here the
base carries the benchmark return through one left join on date (the
benchmark is one row per day, a size the planner checks before broadcasting)
and every statistic is a window on the same ``portfolio_id`` partitioning:
the beta/alpha windows partition by (portfolio_id, has_benchmark), which the
same hash partitioning already satisfies, so the metrics table is shuffled
once (and not at all when it arrives partitioned by portfolio).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.windows import ordered, running, trailing_rows

ADV_COLUMNS = ["portfolio_id", "date", "sharpe_ratio", "sortino_ratio", "max_drawdown", "beta", "alpha"]
PID = "portfolio_id"
FRAME = 30   # rows of the windows of the stored table


def base(metrics: DataFrame) -> DataFrame:
    """rename/prune the metrics view."""
    return metrics.select(PID, "date", F.col("weighted_daily_return").alias("daily_return"), "total_value_gbp")


def benchmark_returns(bench: DataFrame, benchmark: str | None = "SPY") -> DataFrame:
    """Close / previous close - 1 per benchmark symbol.

    One series per benchmark symbol, at most one row per day: when the symbol
    is a constant the optimizer drops the partition key and the lag runs as a
    single task over that (calendar-bounded) series."""
    b = bench if benchmark is None else bench.filter(F.col("symbol") == benchmark)
    c = F.col("close").cast("double")
    return b.select("date", "symbol", (F.try_divide(c, F.lag(c).over(ordered("symbol"))) - 1).alias("benchmark_return"))


def return_stats(b: DataFrame, rows: int = 30) -> DataFrame:
    """Rolling mean, stddev and downside stddev (losses only) of returns."""
    w = trailing_rows(PID, rows)
    r = F.col("daily_return")
    return b.select("*", F.avg(r).over(w).alias("avg_return_30d"),
                    F.stddev_samp(r).over(w).alias("vol_return_30d"),
                    F.stddev_samp(F.when(r < 0, r)).over(w).alias("down_vol_return_30d"))


def sharpe(df: DataFrame) -> DataFrame:
    """M4: avg / vol when vol > 0 else 0 (no risk-free rate, not annualised)."""
    v = F.col("vol_return_30d")
    return df.withColumn("sharpe_ratio", F.when(v > 0, F.col("avg_return_30d") / v).otherwise(F.lit(0.0)))


def sortino(df: DataFrame) -> DataFrame:
    """M5: avg / downside vol when > 0 else 0."""
    v = F.col("down_vol_return_30d")
    return df.withColumn("sortino_ratio", F.when(v > 0, F.col("avg_return_30d") / v).otherwise(F.lit(0.0)))


def drawdown(b: DataFrame, carried: str | None = None) -> DataFrame:
    """W9 + M6: running all-history peak and drawdown from it. Rows that go on from
    stored ones begin with some whose peak is known, in the column ``carried``."""
    v = F.col("total_value_gbp")
    peak = F.max(v if carried is None else F.coalesce(carried, v)).over(running(PID))
    out = b.select("*", peak.alias("running_peak"))
    pk = F.col("running_peak")
    return out.withColumn("drawdown", F.when(pk > 0, (v - pk) / pk).otherwise(F.lit(0.0)))


def max_drawdown(df: DataFrame, rows: int = 30) -> DataFrame:
    """Worst drawdown over the last ``rows`` rows (peak stays all-history)."""
    return df.withColumn("max_drawdown", F.min("drawdown").over(trailing_rows(PID, rows)))


def join_benchmark(b: DataFrame, bench_returns: DataFrame) -> DataFrame:
    """Portfolio returns x benchmark returns on date only (inner)."""
    return (b.join(bench_returns.select("date", "benchmark_return"), "date")
            .select("date", PID, F.col("daily_return").alias("portfolio_return"), "benchmark_return"))


def pair_stats(joined: DataFrame, rows: int = 30, keys=(PID,)) -> DataFrame:
    """Covariance / benchmark variance with n = COUNT(*) of the
    frame (rows with a null return still count), rolling averages, beta, alpha."""
    w = trailing_rows(list(keys), rows)
    p, b = F.col("portfolio_return"), F.col("benchmark_return")
    n = F.count(F.lit(1)).over(w)
    sp, sb = F.sum(p).over(w), F.sum(b).over(w)
    cov = F.when(n > 1, (F.sum(p * b).over(w) - sp * sb / n) / (n - 1))
    var = F.when(n > 1, (F.sum(b * b).over(w) - sb * sb / n) / (n - 1))
    out = joined.select("*", n.alias("rolling_row_count"), cov.alias("covariance_30d"), var.alias("variance_30d"),
                        F.avg(p).over(w).alias("avg_portfolio_return_30d"),
                        F.avg(b).over(w).alias("avg_benchmark_return_30d"))
    c, v = F.col("covariance_30d"), F.col("variance_30d")
    return out.select("*", F.when(v > 0, c / v).alias("beta"),
                      F.when(v > 0, F.col("avg_portfolio_return_30d") - (c / v) * F.col("avg_benchmark_return_30d"))
                      .alias("alpha"))


def with_benchmark(metrics: DataFrame, bench: DataFrame, benchmark: str | None = "SPY") -> DataFrame:
    """The base grid with the benchmark return of each date, and whether it has one."""
    br = benchmark_returns(bench, benchmark).select("date", "benchmark_return", F.lit(True).alias("has_bench"))
    return base(metrics).join(br, "date", "left").withColumn("has_bench", F.coalesce("has_bench", F.lit(False)))


def risk_windows(b: DataFrame, rows: int = 30, carried: str | None = None) -> DataFrame:
    """All risk columns over ``with_benchmark`` rows, beside the columns given."""
    s = max_drawdown(drawdown(sortino(sharpe(return_stats(b, rows))), carried), rows)
    s = pair_stats(s.withColumn("portfolio_return", F.col("daily_return")), rows, keys=(PID, "has_bench"))
    hb = F.col("has_bench")
    return s.withColumn("beta", F.when(hb, F.col("beta"))).withColumn("alpha", F.when(hb, F.col("alpha")))


def advanced_metrics(metrics: DataFrame, bench: DataFrame, benchmark: str | None = "SPY",
                     rows: int = 30) -> DataFrame:
    """M9: FACT_PORTFOLIO_ADV_METRICS on the base grid; dates without a
    benchmark row keep null beta/alpha."""
    return risk_windows(with_benchmark(metrics, bench, benchmark), rows).select(*ADV_COLUMNS)


STATE_COLUMNS = [PID, "date", "daily_return", "total_value_gbp", "benchmark_return", "has_bench", "running_peak",
                 "row_no", "bench_no"]


def go_on(history: DataFrame, new: DataFrame, rows: int = FRAME) -> DataFrame:
    """The risk columns and the state of the ``new`` rows (``with_benchmark``), their windows
    going on from ``history``: stored state rows of the same portfolios, all before the new ones.

    A portfolio's last ``rows - 1`` stored rows, and as many that have a benchmark, are enough:
    the peak and the two row numbers are carried along in each.
    """
    known = history.select(*STATE_COLUMNS[:6], *[F.col(c).alias(f"_{c}") for c in STATE_COLUMNS[6:]])
    w = running(PID)
    is_new = F.col("_row_no").isNull()
    b = (known.unionByName(new.select(*STATE_COLUMNS[:6]), allowMissingColumns=True)
         .select("*", (F.coalesce(F.max("_row_no").over(w), F.lit(0)) + F.count_if(is_new).over(w)).alias("row_no"),
                 (F.coalesce(F.max("_bench_no").over(w), F.lit(0)) + F.count_if(is_new & F.col("has_bench")).over(w)).alias("bench_no")))
    out = risk_windows(b, rows, "_running_peak").filter(is_new)
    return out.select(*STATE_COLUMNS, *ADV_COLUMNS[2:])
