"""Portfolio inputs derived from the driver's TPC-H-like tables.

Each builder is a Spark plan over the parquet files (so its work grows with
them); ``FIXTURE_SQL`` holds the same derivations as DuckDB text for the
oracle. Prices, rates and quantities are exact binary fractions on purpose,
so sums do not depend on evaluation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the fixture world.
DEFAULT_START = "1995-06-01"      # prices keep date > DEFAULT_START
AS_OF = "2001-11-04"              # last ship date: the "today" of the fixture
HISTORY_AS_OF = "2024-01-30 00:00:00"
HISTORY_HOURS = 24
PORTFOLIO = "P1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def equity_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    g = (li.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
                    F.col("l_shipdate").cast("date").alias("date"))
         .agg((F.lit(1000) + (F.min("l_partkey") % 800).cast("double") / 4).alias("op"),
              (F.lit(1000) + (F.sum("l_partkey") % 800).cast("double") / 4).alias("cl"),
              F.sum("l_quantity").cast("bigint").alias("volume")))
    return g.select("symbol", "date", F.col("op").alias("open"),
                    (F.greatest("op", "cl") + 1).alias("high"), (F.least("op", "cl") - 1).alias("low"),
                    F.col("cl").alias("close"), "volume", F.lit("fixture").alias("source"))


def fx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    by_day = o.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n"))
    usd = by_day.select(F.lit("USDGBP").alias("pair"), "date",
                        ((F.lit(90) + F.col("n") % 10).cast("double") / 128).alias("rate"))
    eur = by_day.select(F.lit("EURGBP").alias("pair"), "date",
                        ((F.lit(108) + F.col("n") % 4).cast("double") / 128).alias("rate"))
    return usd.unionByName(eur)


def fact_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("date"))
            .agg((F.lit(4000) + (F.sum("o_custkey") % 400).cast("double") / 4).alias("close"))
            .select(F.lit("SPY").alias("symbol"), "date", "close"))


def portfolio_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    n_sup = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()   # uncorrelated scalar subquery
    final = F.col("o_orderstatus") == "F"
    return o.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("P"), (F.col("o_custkey") % 5).cast("string")).alias("portfolio_id"),
        F.concat(F.lit("S"), (F.col("o_custkey") % n_sup).cast("string")).alias("symbol"),
        (F.when(final, F.lit(-0.25)).otherwise(F.lit(1.0)) * F.floor(F.col("o_totalprice") / 1000))
        .cast("double").alias("quantity_delta"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.when(final, F.lit("SELL")).otherwise(F.lit("BUY")).alias("transaction_type"))


def dim_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return (s.filter(F.col("s_suppkey") % 10 != 9)
            .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
                    F.col("s_name").alias("company_name"), F.lit("USD").alias("currency")))


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("query_id"),
        F.col("user_id").cast("string").alias("user_name"),
        F.when(F.col("event_type") == "view", F.lit("SELECT")).otherwise(F.upper("event_type")).alias("query_type"),
        F.col("ts").cast("timestamp_ntz").alias("start_time"),
        (F.col("value") * 10).alias("total_elapsed_time"),
        (F.col("event_id") % 1000).alias("rows_produced"),
        F.floor(F.col("value") * 1048576).cast("bigint").alias("bytes_scanned"),
        F.col("props").alias("query_text"))


# The same derivations for DuckDB (views lineitem, orders, supplier, events are registered).
FIXTURE_SQL = {
    "equity_daily": """
        select symbol, "date", op as open, greatest(op, cl) + 1 as high, least(op, cl) - 1 as low,
               cl as close, volume, 'fixture' as source
        from (select concat('S', cast(l_suppkey as varchar)) as symbol, cast(l_shipdate as date) as "date",
                     1000 + cast(min(l_partkey) % 800 as double) / 4 as op,
                     1000 + cast(sum(l_partkey) % 800 as double) / 4 as cl,
                     cast(sum(l_quantity) as bigint) as volume
              from lineitem group by 1, 2) z""",
    "fx_daily": """
        select 'USDGBP' as pair, cast(o_orderdate as date) as "date", cast(90 + count(*) % 10 as double) / 128 as rate
        from orders group by 2
        union all
        select 'EURGBP', cast(o_orderdate as date), cast(108 + count(*) % 4 as double) / 128 from orders group by 2""",
    "fact_benchmark": """
        select 'SPY' as symbol, cast(o_orderdate as date) as "date",
               4000 + cast(sum(o_custkey) % 400 as double) / 4 as close
        from orders group by 2""",
    "portfolio_transactions": """
        select cast(o_orderkey as varchar) as transaction_id,
               concat('P', cast(o_custkey % 5 as varchar)) as portfolio_id,
               concat('S', cast(o_custkey % (select count(*) from supplier) as varchar)) as symbol,
               cast(case when o_orderstatus = 'F' then -0.25 else 1.0 end * floor(o_totalprice / 1000) as double)
                   as quantity_delta,
               cast(o_orderdate as date) as transaction_date,
               case when o_orderstatus = 'F' then 'SELL' else 'BUY' end as transaction_type
        from orders""",
    "dim_symbol": """
        select concat('S', cast(s_suppkey as varchar)) as symbol, s_name as company_name, 'USD' as currency
        from supplier where s_suppkey % 10 <> 9""",
    "query_history": """
        select event_id as query_id, cast(user_id as varchar) as user_name,
               case when event_type = 'view' then 'SELECT' else upper(event_type) end as query_type,
               cast(ts as timestamp) as start_time, value * 10 as total_elapsed_time,
               event_id % 1000 as rows_produced, cast(floor(value * 1048576) as bigint) as bytes_scanned,
               props as query_text
        from events""",
}


def with_fixtures(body: str, *extra: tuple[str, str]) -> str:
    """DuckDB text: fixture CTEs (+ extra named CTEs) followed by ``body``."""
    ctes = [f"{n} as ({s})" for n, s in FIXTURE_SQL.items()]
    ctes += [f"{n} as ({s})" for n, s in extra]
    return "with " + ",\n".join(ctes) + "\n" + body
