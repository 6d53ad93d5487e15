"""Table schemas (the DDL of the warehouse, as StructTypes) and conformers.

Stored tables keep the declared decimal types; computations downstream of the
price table run in double (risk outputs are FLOAT in the DDL anyway).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

S, D, DBL, L, TS = StringType(), DateType(), DoubleType(), LongType(), TimestampNTZType()


def _st(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# Table and column names and types of the warehouse DDL.
EQUITY_DAILY = _st(("symbol", S, False), ("date", D, False), ("open", DecimalType(18, 6), True),
                   ("high", DecimalType(18, 6), True), ("low", DecimalType(18, 6), True),
                   ("close", DecimalType(18, 6), True), ("volume", L, True), ("source", S, True),
                   ("_ingested_at", TS, True))
FX_DAILY = _st(("pair", S, False), ("date", D, False), ("rate", DecimalType(18, 8), True),
               ("source", S, True), ("_ingested_at", TS, True))
LOAD_METADATA = _st(("source", S, False), ("last_loaded_date", D, True), ("_updated_at", TS, True))
PORTFOLIO_POSITIONS = _st(("portfolio_id", S, False), ("symbol", S, False),
                          ("quantity", DecimalType(18, 6), True), ("_ingested_at", TS, True))
FACT_PRICES = _st(("symbol", S, True), ("date", D, True), ("company_name", S, True), ("currency", S, True),
                  ("open", DecimalType(18, 6), True), ("high", DecimalType(18, 6), True),
                  ("low", DecimalType(18, 6), True), ("close", DecimalType(18, 6), True),
                  ("volume", L, True), ("usd_to_gbp", DecimalType(18, 8), True),
                  ("close_gbp", DecimalType(34, 12), True), ("daily_return", DecimalType(31, 12), True),
                  ("rolling_7d_avg_close", DecimalType(33, 9), True), ("rolling_30d_volatility", DBL, True))
PIPELINE_MONITORING = _st(("run_id", S, True), ("run_date", D, True), ("task_name", S, True),
                          ("status", S, True), ("record_count", L, True), ("error_message", S, True),
                          ("_logged_at", TS, True))
PORTFOLIO_TRANSACTIONS = _st(("transaction_id", S, False), ("portfolio_id", S, True), ("symbol", S, True),
                             ("quantity_delta", DecimalType(18, 6), True), ("transaction_date", D, True),
                             ("transaction_type", S, True), ("_ingested_at", TS, True))
PORTFOLIO_POSITIONS_DAILY = _st(("portfolio_id", S, False), ("symbol", S, False), ("date", D, False),
                                ("quantity", DecimalType(18, 6), True), ("_created_at", TS, True))
FACT_BENCHMARK = _st(("date", D, False), ("symbol", S, False), ("close", DecimalType(18, 6), True))
FACT_PORTFOLIO_ADV_METRICS = _st(("date", D, False), ("portfolio_id", S, False), ("sharpe_ratio", DBL, True),
                                 ("sortino_ratio", DBL, True), ("max_drawdown", DBL, True),
                                 ("beta", DBL, True), ("alpha", DBL, True))
DIM_SYMBOL = _st(("symbol", S, False), ("company_name", S, True), ("currency", S, True))
VIEW_PORTFOLIO_METRICS = _st(("portfolio_id", S, True), ("date", D, True), ("total_value_gbp", DBL, True),
                             ("weighted_daily_return", DBL, True), ("rolling_30d_volatility", DBL, True),
                             ("daily_var_95", DBL, True))
PORTFOLIO_DAILY = _st(("portfolio_id", S, False), ("date", D, False), ("total_value_gbp", DBL, True),
                      ("weighted_daily_return", DBL, True))
PORTFOLIO_ADV_STATE = _st(("portfolio_id", S, False), ("date", D, False), ("daily_return", DBL, True),
                          ("total_value_gbp", DBL, True), ("benchmark_return", DBL, True), ("has_bench", BooleanType(), True),
                          ("running_peak", DBL, True), ("row_no", L, True), ("bench_no", L, True))
PIPELINE_ALERTS = _st(("run_id", S, True), ("run_date", D, True), ("message", S, True), ("_logged_at", TS, True))
PIPELINE_PROFILE = _st(("run_id", S, True), ("run_date", D, True), ("report", S, True), ("line", S, True))
QUERY_HISTORY = _st(("query_id", L, True), ("user_name", S, True), ("warehouse_name", S, True),
                    ("database_name", S, True), ("schema_name", S, True), ("query_type", S, True),
                    ("start_time", TimestampNTZType(), True), ("total_elapsed_time", DBL, True), ("rows_produced", L, True),
                    ("bytes_scanned", L, True), ("query_text", S, True))

# Transactions CSV: the six business columns, all required.
TRANSACTION_COLUMNS = ["transaction_id", "portfolio_id", "symbol", "quantity_delta",
                       "transaction_date", "transaction_type"]


@dataclass(frozen=True)
class Table:
    name: str
    schema: StructType
    keys: tuple = ()
    partition_by: tuple = field(default=())   # key columns / derived names; empty: key hash buckets
    buckets: int = 16                          # hash buckets when partition_by is empty


TABLES = {t.name: t for t in [
    Table("equity_daily", EQUITY_DAILY, ("symbol", "date"), ("month",)),
    Table("fx_daily", FX_DAILY, ("pair", "date"), ("month",)),
    Table("load_metadata", LOAD_METADATA, ("source",)),
    Table("portfolio_positions", PORTFOLIO_POSITIONS, ("portfolio_id", "symbol")),
    Table("fact_prices", FACT_PRICES, ("symbol", "date"), ("month",)),
    Table("pipeline_monitoring", PIPELINE_MONITORING, ()),
    Table("portfolio_transactions", PORTFOLIO_TRANSACTIONS, ("transaction_id",)),
    Table("portfolio_positions_daily", PORTFOLIO_POSITIONS_DAILY, ("portfolio_id", "symbol", "date"), ("month",)),
    Table("fact_benchmark", FACT_BENCHMARK, ("date", "symbol"), ("month",)),
    Table("fact_portfolio_adv_metrics", FACT_PORTFOLIO_ADV_METRICS, ("date", "portfolio_id"), ("month",)),
    Table("dim_symbol", DIM_SYMBOL, ("symbol",)),
    # the holdings join aggregated to a day (the small table that all windows read), and the metrics view stored
    Table("portfolio_daily", PORTFOLIO_DAILY, ("portfolio_id", "date"), ("month",)),
    Table("fact_portfolio_metrics", VIEW_PORTFOLIO_METRICS, ("portfolio_id", "date"), ("month",)),
    # what the windows of the advanced metrics go on from
    Table("portfolio_adv_state", PORTFOLIO_ADV_STATE, ("portfolio_id", "date"), ("month",)),
    Table("pipeline_alerts", PIPELINE_ALERTS, ()),
    Table("pipeline_profile", PIPELINE_PROFILE, ()),
]}


def conform(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Select the schema's columns in order, cast to declared types.

    Missing columns become ``defaults[name]`` (a Column) or typed null.
    """
    defaults = defaults or {}
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        if f.name.lower() in have:
            c = F.col(have[f.name.lower()])
        elif f.name in defaults:
            c = defaults[f.name]
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def as_double(df: DataFrame) -> DataFrame:
    """Decimal columns to double (for computation past the storage layer)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])
