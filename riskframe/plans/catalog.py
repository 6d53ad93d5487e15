"""Query catalog: one entry per operator key of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables (or
data Spark derives from them) and, where SQL can express it, has a DuckDB
oracle over the same parquet files. Ratios and deviations are rounded to
``DIGITS`` decimals on both sides; everything else is compared as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import advanced as adv
from ..operators import metrics as met
from ..operators import positions as pos
from ..operators import prices as prc
from . import fixtures as fx
from . import oracle_sql as o
from .fixtures import AS_OF, DEFAULT_START, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(df: DataFrame, *cols: str, digits: int = o.DIGITS) -> DataFrame:
    """Round the named double columns in place (column order kept); -0.0 becomes 0.0."""
    return df.select(*[(F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------- shared chains
def prices_of(spark, d, history="window") -> DataFrame:
    return prc.fact_prices(fx.equity_daily(spark, d), fx.fx_daily(spark, d), fx.dim_symbol(spark, d),
                           after=None, default_start=DEFAULT_START, history=history)


def positions_of(spark, d) -> DataFrame:
    return pos.positions_daily(fx.portfolio_transactions(spark, d), as_of=AS_OF)


def metrics_of(spark, d) -> DataFrame:
    return met.portfolio_metrics(prices_of(spark, d), positions_of(spark, d))


def advanced_of(spark, d) -> DataFrame:
    return adv.advanced_metrics(metrics_of(spark, d), fx.fact_benchmark(spark, d))


PRICE_ROUND = ("rolling_30d_volatility", "daily_return", "rolling_7d_avg_close")
METRIC_ROUND = ("weighted_daily_return", "rolling_30d_volatility", "daily_var_95")
ADV_ROUND = ("sharpe_ratio", "sortino_ratio", "max_drawdown", "beta", "alpha")

PRICE_SELECT = ", ".join(c if c not in PRICE_ROUND else o.r(c) for c in prc.PRICE_COLUMNS)
METRIC_SELECT = ", ".join(c if c not in METRIC_ROUND else o.r(c) for c in met.METRIC_COLUMNS)
ADV_SELECT = ", ".join(c if c not in ADV_ROUND else o.r(c) for c in adv.ADV_COLUMNS)


# ---------------------------------------------------------------- composite metrics (2.10)
@register("fact_prices", with_fixtures(f"select {PRICE_SELECT} from fact_prices", *o.PRICE_CHAIN))
def q_fact_prices(spark, d):
    return rnd(prices_of(spark, d), *PRICE_ROUND)


@register("fact_prices_increment",
          with_fixtures(f"select {PRICE_SELECT} from fact_prices_increment", o.PRICES_JOINED, o.FACT_PRICES_INCREMENT))
def q_fact_prices_increment(spark, d):
    return rnd(prices_of(spark, d, history="increment"), *PRICE_ROUND)


@register("positions_daily", with_fixtures("select * from positions_daily", *o.POSITIONS))
def q_positions_daily(spark, d):
    return positions_of(spark, d)


@register("portfolio_metrics", with_fixtures(f"select {METRIC_SELECT} from portfolio_metrics", *o.METRIC_CHAIN))
def q_portfolio_metrics(spark, d):
    return rnd(metrics_of(spark, d), *METRIC_ROUND)


@register("advanced_metrics", with_fixtures(f"select {ADV_SELECT} from advanced_metrics", *o.ADVANCED_CHAIN))
def q_advanced_metrics(spark, d):
    return rnd(advanced_of(spark, d), *ADV_ROUND)


# the remaining entries register themselves on import
from . import catalog_ops as _ops  # noqa: E402,F401
from . import catalog_io as _io  # noqa: E402,F401
