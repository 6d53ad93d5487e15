"""Catalog entries: cleaning, projections, joins, aggregates, windows, sorts,
scalar functions, serving and data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators import advanced as adv
from ..operators import clean as cl
from ..operators import metrics as met
from ..operators import positions as pos
from ..operators import prices as prc
from ..operators import profiling as prof
from ..operators import quality as dq
from ..operators import serving as sv
from ..plans import incremental as inc
from ..sources import files as src
from . import fixtures as fx
from . import oracle_sql as o
from .catalog import (ADV_ROUND, METRIC_ROUND, PRICE_ROUND, advanced_of, metrics_of, positions_of, prices_of,
                      register, rnd)
from .fixtures import AS_OF, HISTORY_AS_OF, HISTORY_HOURS, PORTFOLIO, with_fixtures as wf

D1 = "1998-12-31"          # batch boundary used by the two-batch entries
r = o.r


def _sel(cols, rounded):
    return ", ".join(r(c) if c in rounded else c for c in cols)


# ------------------------------------------------------------------ 2.3 cleaning
# Injected defects (same rule on both engines): close null on day 13, volume text
# 'x' on day 7 and null on day 8, a second (different) row for every key on day 21.
DIRTY_EQUITY_SQL = ("dirty_equity", """
    select symbol, "date", open, high, low, case when day("date") = 13 then null else close end as close,
           case when day("date") = 7 then 'x' when day("date") = 8 then null else cast(volume as varchar) end as volume,
           source
    from equity_daily
    union all
    select symbol, "date", open + 100, high, low, close, cast(volume as varchar), source
    from equity_daily where day("date") = 21""")


def dirty_equity(spark, d):
    e = fx.equity_daily(spark, d)
    day = F.dayofmonth("date")
    a = e.select("symbol", "date", "open", "high", "low", F.when(day == 13, F.lit(None)).otherwise(F.col("close"))
                 .alias("close"),
                 F.when(day == 7, F.lit("x")).when(day == 8, F.lit(None)).otherwise(F.col("volume").cast("string"))
                 .alias("volume"), "source")
    b = e.filter(day == 21).select("symbol", "date", (F.col("open") + 100).alias("open"), "high", "low", "close",
                                   F.col("volume").cast("string").alias("volume"), "source")
    return a.unionByName(b)


@register("clean_equities", wf("""
    select symbol, "date", open, high, low, close, volume, source from (
      select symbol, "date", open, high, low, close, coalesce(try_cast(volume as double), 0) as volume, source,
             row_number() over (partition by symbol, "date" order by open nulls first, high nulls first,
                                low nulls first, close nulls first, coalesce(try_cast(volume as double), 0) nulls first,
                                source nulls first) as rn
      from dirty_equity where symbol is not null and "date" is not null and close is not null) z
    where rn = 1""", DIRTY_EQUITY_SQL))
def q_clean_equities(spark, d):
    return cl.clean_equities(dirty_equity(spark, d))


DIRTY_FX_SQL = ("dirty_fx", """
    select case when day("date") = 13 then null else pair end as pair, strftime("date", '%Y-%m-%d') as "date",
           case when day("date") = 7 then 'x' else cast(rate as varchar) end as rate
    from fx_daily
    union all
    select pair, strftime("date", '%Y-%m-%d'), cast(rate + 1 as varchar) from fx_daily where day("date") = 21""")


def dirty_fx(spark, d):
    f = fx.fx_daily(spark, d)
    day = F.dayofmonth("date")
    a = f.select(F.when(day == 13, F.lit(None)).otherwise(F.col("pair")).alias("pair"),
                 F.date_format("date", "yyyy-MM-dd").alias("date"),
                 F.when(day == 7, F.lit("x")).otherwise(F.col("rate").cast("string")).alias("rate"))
    b = f.filter(day == 21).select("pair", F.date_format("date", "yyyy-MM-dd").alias("date"),
                                   (F.col("rate") + 1).cast("string").alias("rate"))
    return a.unionByName(b)


@register("clean_fx", wf("""
    select pair, "date", rate from (
      select pair, cast("date" as date) as "date", try_cast(rate as double) as rate,
             row_number() over (partition by pair, cast("date" as date) order by try_cast(rate as double)) as rn
      from dirty_fx where pair is not null and "date" is not null and rate is not null
        and try_cast(rate as double) is not null) z
    where rn = 1""", DIRTY_FX_SQL))
def q_clean_fx(spark, d):
    return cl.clean_fx(dirty_fx(spark, d))


@register("dedupe_first", wf("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, ship_date from (
      select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey nulls first,
               l_suppkey nulls first, l_quantity nulls first, l_extendedprice nulls first, l_discount nulls first,
               l_tax nulls first, l_returnflag nulls first, l_linestatus nulls first, ship_date nulls first) as rn
      from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus, cast(l_shipdate as date) as ship_date from lineitem) s) z
    where rn = 1"""))
def q_dedupe_first(spark, d):
    li = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("ship_date"))
    return cl.dedupe_first(li, ["l_orderkey", "l_linenumber"])


@register("upper_columns", wf("""select symbol as "SYMBOL", company_name as "COMPANY_NAME", currency as "CURRENCY"
                                 from dim_symbol"""))
def q_upper_columns(spark, d):
    return cl.upper_columns(fx.dim_symbol(spark, d))


@register("normalise_symbol", wf("""
    select raw, upper(trim(raw)) as symbol
    from (select concat('  ', lower(symbol), ' ') as raw from dim_symbol) z"""))
def q_normalise_symbol(spark, d):
    raw = fx.dim_symbol(spark, d).select(F.concat(F.lit("  "), F.lower("symbol"), F.lit(" ")).alias("raw"))
    return raw.select("raw", fc.normalise_key("raw").alias("symbol"))


@register("coerce_numeric", wf("""
    select symbol, "date", try_cast(close_text as double) as close, coalesce(try_cast(volume_text as double), 0) as volume
    from (select symbol, "date",
                 case when day("date") = 7 then 'x' else cast(close as varchar) end as close_text,
                 case when day("date") = 8 then '' when day("date") = 9 then null else cast(volume as varchar) end
                     as volume_text
          from equity_daily) z"""))
def q_coerce_numeric(spark, d):
    e = fx.equity_daily(spark, d)
    day = F.dayofmonth("date")
    t = e.select("symbol", "date",
                 F.when(day == 7, F.lit("x")).otherwise(F.col("close").cast("string")).alias("close_text"),
                 F.when(day == 8, F.lit("")).when(day == 9, F.lit(None)).otherwise(F.col("volume").cast("string"))
                 .alias("volume_text"))
    return t.select("symbol", "date", fc.to_number("close_text").alias("close"),
                    fc.to_number("volume_text", fill=0).alias("volume"))


@register("split_pair", wf("""select pair, "date", substring(pair, 1, 3) as base_currency,
                                     substring(pair, 4, 3) as quote_currency from fx_daily"""))
def q_split_pair(spark, d):
    f = fx.fx_daily(spark, d)
    b, q = fc.split_pair("pair")
    return f.select("pair", "date", b.alias("base_currency"), q.alias("quote_currency"))


@register("price_projection", wf("select * from prices_joined", o.PRICES_JOINED))
def q_price_projection(spark, d):
    return prc.project(prc.join_dim(prc.join_fx(fx.equity_daily(spark, d), fx.fx_daily(spark, d)),
                                    fx.dim_symbol(spark, d)))


HOLDING_COLS = ["portfolio_id", "date", "symbol", "close_gbp", "daily_return", "quantity", "position_value_gbp"]


@register("holding_value", wf(f"select {_sel(HOLDING_COLS, ('daily_return',))} from worth", *o.METRIC_CHAIN))
def q_holding_value(spark, d):
    return rnd(met.holdings(prices_of(spark, d), positions_of(spark, d)), "daily_return")


@register("pair_filter", wf("select pair, \"date\", rate from fx_daily where pair = 'USDGBP'"))
def q_pair_filter(spark, d):
    return fx.fx_daily(spark, d).filter(F.col("pair") == "USDGBP")


@register("rename_project", wf(f"select portfolio_id, \"date\", {r('weighted_daily_return', 'daily_return')}, total_value_gbp from totals",
                               *o.ADVANCED_CHAIN))
def q_rename_project(spark, d):
    return rnd(adv.base(metrics_of(spark, d)), "daily_return")


METRIC_SEL = _sel(met.METRIC_COLUMNS, METRIC_ROUND)


@register("portfolio_filter", wf(f"select {METRIC_SEL} from portfolio_metrics where portfolio_id = '{PORTFOLIO}'",
                                 *o.METRIC_CHAIN))
def q_portfolio_filter(spark, d):
    m = metrics_of(spark, d)
    return rnd(m.filter(F.col("portfolio_id") == F.lit(PORTFOLIO)), *METRIC_ROUND)


@register("date_window_filter", wf("""select * from portfolio_transactions
                                      where transaction_date > date '1997-06-30' and transaction_date <= date '2000-06-30'"""))
def q_date_window_filter(spark, d):
    return pos.window_rows(fx.portfolio_transactions(spark, d), "1997-06-30", "2000-06-30")


HISTORY_WINDOW_SQL = (f"start_time >= timestamp '{HISTORY_AS_OF}' - interval {HISTORY_HOURS} hour "
                      f"and start_time <= timestamp '{HISTORY_AS_OF}'")
HISTORY_COLS = ("query_id, user_name, cast(null as varchar) as warehouse_name, cast(null as varchar) as database_name, "
                "cast(null as varchar) as schema_name, query_type, start_time, total_elapsed_time, rows_produced, "
                "bytes_scanned, query_text")


def history_of(spark, d):
    from ..schemas import QUERY_HISTORY, conform
    return conform(fx.query_history(spark, d), QUERY_HISTORY)


@register("select_type_filter", wf(f"""select query_id, query_type, start_time from query_history
                                       where {HISTORY_WINDOW_SQL} and query_type = 'SELECT'"""))
def q_select_type_filter(spark, d):
    h = src.history_window(history_of(spark, d), HISTORY_AS_OF, HISTORY_HOURS)
    return h.filter(F.col("query_type") == "SELECT").select("query_id", "query_type", "start_time")


# ------------------------------------------------------------------ 2.4 joins
@register("join_prices_fx", wf("""select e.*, fx.rate as usd_to_gbp from equity_daily e
                                   join fx_daily fx on fx."date" = e."date" and fx.pair = 'USDGBP'"""))
def q_join_prices_fx(spark, d):
    return prc.join_fx(fx.equity_daily(spark, d), fx.fx_daily(spark, d))


@register("join_prices_dim", wf("""select e.*, d.company_name, d.currency from equity_daily e
                                    left join dim_symbol d on e.symbol = d.symbol"""))
def q_join_prices_dim(spark, d):
    return prc.join_dim(fx.equity_daily(spark, d), fx.dim_symbol(spark, d))


@register("join_holdings", wf("""select pos.portfolio_id, fp.symbol, fp."date", fp.close_gbp, pos.quantity
                                  from fact_prices fp join positions_daily pos
                                  on fp.symbol = pos.symbol and fp."date" = pos."date" """, *o.PRICE_CHAIN, *o.POSITIONS))
def q_join_holdings(spark, d):
    return met.holdings(prices_of(spark, d), positions_of(spark, d)).select(
        "portfolio_id", "symbol", "date", "close_gbp", "quantity")


VAR_SQL = wf(f"select portfolio_id, \"date\", {r('daily_var_95')} from portfolio_metrics", *o.METRIC_CHAIN)


@register("band_join_var", VAR_SQL)
def q_band_join_var(spark, d):
    daily = met.daily(met.holdings(prices_of(spark, d), positions_of(spark, d)))
    return rnd(met.rolling_var(daily).select("portfolio_id", "date", "daily_var_95"), "daily_var_95")


@register("daily_var_95", VAR_SQL)
def q_daily_var_95(spark, d):
    return q_band_join_var(spark, d)


@register("join_prior_positions", wf(f"""
    select b.symbol, b.portfolio_id, coalesce(p.quantity, 0) as prior_qty
    from pair_list b left join positions_daily p
      on b.symbol = p.symbol and b.portfolio_id = p.portfolio_id and p."date" = date '{D1}'""", *o.POSITIONS))
def q_join_prior_positions(spark, d):
    t = fx.portfolio_transactions(spark, d)
    return pos.priors(pos.pairs(t), positions_of(spark, d), D1)


@register("cross_spine", wf("select b.symbol, b.portfolio_id, s.\"date\" from pair_list b cross join calendar s",
                            *o.POSITIONS))
def q_cross_spine(spark, d):
    t = fx.portfolio_transactions(spark, d)
    return pos.cross_spine(pos.pairs(t), pos.start_date(t), AS_OF)


@register("join_deltas", wf("""
    select symbol, portfolio_id, "date", sum(traded) as qty_delta
    from (select symbol, portfolio_id, "date", 0.0::double as traded from pair_list, calendar
          union all select symbol, portfolio_id, day, traded from trade_days) z
    group by symbol, portfolio_id, "date" """, *o.POSITIONS))
def q_join_deltas(spark, d):
    t = fx.portfolio_transactions(spark, d)
    start = pos.start_date(t)
    return pos.matrix(pos.cross_spine(pos.pairs(t), start, AS_OF), pos.deltas(t, start, AS_OF)).select(
        "symbol", "portfolio_id", "date", "qty_delta")


@register("join_priors", wf(f"select * from positions_daily where \"date\" > date '{D1}'", *o.POSITIONS))
def q_join_priors(spark, d):
    """Positions after D1 seeded with the stored quantity at D1 (the incremental form)."""
    t = fx.portfolio_transactions(spark, d)
    base = pos.priors(pos.pairs(t), positions_of(spark, d), D1)
    grid = pos.matrix(pos.cross_spine(base, D1, AS_OF), pos.deltas(t, D1, AS_OF))
    return pos.running_quantity(grid)


@register("running_quantity", wf("select * from positions_daily", *o.POSITIONS))
def q_running_quantity(spark, d):
    t = fx.portfolio_transactions(spark, d)
    start = pos.start_date(t)
    return pos.running_quantity(pos.matrix(pos.cross_spine(pos.pairs(t), start, AS_OF), pos.deltas(t, start, AS_OF)))


@register("join_benchmark", wf(f"""select "date", portfolio_id, {r('x', 'portfolio_return')}, {r('y', 'benchmark_return')}
                                   from beside_market""", *o.ADVANCED_CHAIN))
def q_join_benchmark(spark, d):
    j = adv.join_benchmark(adv.base(metrics_of(spark, d)), adv.benchmark_returns(fx.fact_benchmark(spark, d)))
    return rnd(j, "portfolio_return", "benchmark_return")


ADV_SEL = _sel(adv.ADV_COLUMNS, ADV_ROUND)


@register("join_metric_star", wf(f"select {ADV_SEL} from advanced_metrics", *o.ADVANCED_CHAIN))
def q_join_metric_star(spark, d):
    return rnd(advanced_of(spark, d), *ADV_ROUND)


# ------------------------------------------------------------------ 2.5 aggregates
@register("portfolio_total_value", wf("select portfolio_id, \"date\", total_value_gbp from totals", *o.METRIC_CHAIN))
def q_portfolio_total_value(spark, d):
    return met.daily(met.holdings(prices_of(spark, d), positions_of(spark, d))).select(
        "portfolio_id", "date", "total_value_gbp")


@register("weighted_daily_return", wf(f"select portfolio_id, \"date\", {r('weighted_daily_return')} from totals",
                                      *o.METRIC_CHAIN))
def q_weighted_daily_return(spark, d):
    dl = met.daily(met.holdings(prices_of(spark, d), positions_of(spark, d)))
    return rnd(dl.select("portfolio_id", "date", "weighted_daily_return"), "weighted_daily_return")


@register("daily_deltas", wf("select portfolio_id, symbol, day as \"date\", traded as qty_delta from trade_days",
                              *o.POSITIONS))
def q_daily_deltas(spark, d):
    t = fx.portfolio_transactions(spark, d)
    return pos.deltas(t, pos.start_date(t), AS_OF)


@register("distinct_pairs", wf("select * from pair_list", *o.POSITIONS))
def q_distinct_pairs(spark, d):
    return pos.pairs(fx.portfolio_transactions(spark, d))


@register("first_transaction_date", wf("select first_day - 1 as last_date from opening", *o.POSITIONS))
def q_first_transaction_date(spark, d):
    return pos.start_date(fx.portfolio_transactions(spark, d))


@register("count_on_date", wf(f"""select cast(count(*) filter (where "date" = date '{AS_OF}') as bigint) as record_count
                                  from equity_daily"""))
def q_count_on_date(spark, d):
    return dq.count_on(fx.equity_daily(spark, d), "date", AS_OF)


@register("count_rows", wf("select count(*) as record_count from positions_daily", *o.POSITIONS))
def q_count_rows(spark, d):
    return dq.count_rows(positions_of(spark, d))


@register("batch_max_date", wf(f"""select max("date") as last_loaded_date from equity_daily
                                   where "date" > (select max("date") - 400 from equity_daily)"""))
def q_batch_max_date(spark, d):
    e = fx.equity_daily(spark, d)
    meta = e.agg(F.lit("equities").alias("source"), F.date_sub(F.max("date"), 400).alias("last_loaded_date"))
    return inc.batch_max(inc.new_rows(e, meta, "equities"))


@register("filter_new_rows", wf("""select * from equity_daily
                                   where "date" > (select max("date") - 400 from equity_daily)"""))
def q_filter_new_rows(spark, d):
    e = fx.equity_daily(spark, d)
    meta = e.agg(F.lit("equities").alias("source"), F.date_sub(F.max("date"), 400).alias("last_loaded_date"))
    return inc.new_rows(e, meta, "equities")


def _null_sql(cols, table):
    parts = [f"select '{c}' as column_name, cast(count(*) - count({c}) as bigint) as null_count from {table}"
             for c in cols]
    return " union all ".join(parts)


@register("null_counts", wf(_null_sql(["\"date\"" if c == "date" else c for c in prc.PRICE_COLUMNS], "fact_prices")
                            .replace("'\"date\"'", "'date'"), *o.PRICE_CHAIN))
def q_null_counts(spark, d):
    return dq.null_counts(prices_of(spark, d))


@register("duplicate_key_rows", wf("""select cast(coalesce(sum(n - 1), 0) as bigint) as dupe_pk_rows
                                      from (select count(*) as n from lineitem group by l_orderkey, l_linenumber) z"""))
def q_duplicate_key_rows(spark, d):
    return dq.duplicate_rows(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------------ 2.6 windows
def _price_col(name):
    @register(name, wf(f"select symbol, \"date\", {r(PRICE_MAP[name])} from fact_prices", *o.PRICE_CHAIN))
    def q(spark, d):
        return rnd(prices_of(spark, d).select("symbol", "date", PRICE_MAP[name]), PRICE_MAP[name])
    return q


PRICE_MAP = {"daily_return": "daily_return", "rolling_7d_avg_close": "rolling_7d_avg_close",
             "rolling_30d_price_vol": "rolling_30d_volatility"}
for _n in PRICE_MAP:
    _price_col(_n)


@register("rolling_30d_volatility", wf(f"select portfolio_id, \"date\", {r('rolling_30d_volatility')} "
                                       f"from portfolio_metrics", *o.METRIC_CHAIN))
def q_rolling_30d_volatility(spark, d):
    dl = met.daily(met.holdings(prices_of(spark, d), positions_of(spark, d)))
    return rnd(met.with_volatility(dl).select("portfolio_id", "date", "rolling_30d_volatility"),
               "rolling_30d_volatility")


def _stats_base(spark, d):
    return adv.base(metrics_of(spark, d))


STAT_MAP = {"rolling_avg_return": ("avg_return_30d", "month_stats", "mean_return"),
            "rolling_return_vol": ("vol_return_30d", "month_stats", "deviation"),
            "downside_vol": ("down_vol_return_30d", "month_stats", "loss_deviation")}


def _stat_col(name):
    col, cte, sql_col = STAT_MAP[name]

    @register(name, wf(f"select portfolio_id, \"date\", {r(sql_col, col)} from {cte}", *o.ADVANCED_CHAIN))
    def q(spark, d):
        return rnd(adv.return_stats(_stats_base(spark, d)).select("portfolio_id", "date", col), col)
    return q


for _n in STAT_MAP:
    _stat_col(_n)


@register("running_peak", wf("select portfolio_id, \"date\", running_peak from falls", *o.ADVANCED_CHAIN))
def q_running_peak(spark, d):
    return adv.drawdown(_stats_base(spark, d)).select("portfolio_id", "date", "running_peak")


@register("drawdown", wf(f"select portfolio_id, \"date\", {r('drawdown')} from falls", *o.ADVANCED_CHAIN))
def q_drawdown(spark, d):
    return rnd(adv.drawdown(_stats_base(spark, d)).select("portfolio_id", "date", "drawdown"), "drawdown")


@register("max_drawdown", wf(f"select portfolio_id, \"date\", {r('max_drawdown')} from advanced_metrics",
                             *o.ADVANCED_CHAIN))
def q_max_drawdown(spark, d):
    return rnd(adv.max_drawdown(adv.drawdown(_stats_base(spark, d))).select("portfolio_id", "date", "max_drawdown"),
               "max_drawdown")


@register("benchmark_return", wf(f"select \"date\", symbol, {r('benchmark_return')} from market",
                                 *o.ADVANCED_CHAIN))
def q_benchmark_return(spark, d):
    return rnd(adv.benchmark_returns(fx.fact_benchmark(spark, d)), "benchmark_return")


PAIR_MAP = {"rolling_row_count": (["rolling_row_count"], ["n as rolling_row_count"]),
            "rolling_covariance_30d": (["covariance_30d"], [r("covariance_30d")]),
            "rolling_benchmark_variance_30d": (["variance_30d"], [r("variance_30d")]),
            "rolling_pair_averages": (["avg_portfolio_return_30d", "avg_benchmark_return_30d"],
                                      [r("avg_portfolio_return_30d"), r("avg_benchmark_return_30d")])}


def _pair_col(name):
    cols, sql_cols = PAIR_MAP[name]

    @register(name, wf(f"select portfolio_id, \"date\", {', '.join(sql_cols)} from comoments", *o.ADVANCED_CHAIN))
    def q(spark, d):
        j = adv.join_benchmark(_stats_base(spark, d), adv.benchmark_returns(fx.fact_benchmark(spark, d)))
        out = adv.pair_stats(j).select("portfolio_id", "date", *cols)
        return rnd(out, *[c for c in cols if c != "rolling_row_count"])
    return q


for _n in PAIR_MAP:
    _pair_col(_n)


def _adv_col(name):
    @register(name, wf(f"select portfolio_id, \"date\", {r(name)} from advanced_metrics", *o.ADVANCED_CHAIN))
    def q(spark, d):
        return rnd(advanced_of(spark, d).select("portfolio_id", "date", name), name)
    return q


for _n in ("sharpe_ratio", "sortino_ratio", "beta", "alpha"):
    _adv_col(_n)


# ------------------------------------------------------------------ 2.7 sorts / top-k and 2.12 serving
@register("latest_metrics", wf(f"""select {METRIC_SEL} from portfolio_metrics where portfolio_id = '{PORTFOLIO}'
                                   order by "date" desc limit 30""", *o.METRIC_CHAIN))
def q_latest_metrics(spark, d):
    return rnd(sv.latest(metrics_of(spark, d), PORTFOLIO, 30), *METRIC_ROUND)


@register("latest_metrics_all", wf(f"""select {METRIC_SEL} from (
        select *, row_number() over (partition by portfolio_id order by "date" desc) as rn from portfolio_metrics) z
    where rn <= 30""", *o.METRIC_CHAIN))
def q_latest_metrics_all(spark, d):
    return rnd(sv.latest(metrics_of(spark, d), None, 30), *METRIC_ROUND)


@register("latest_advanced", wf(f"""select {ADV_SEL} from advanced_metrics where portfolio_id = '{PORTFOLIO}'
                                    order by "date" desc limit 30""", *o.ADVANCED_CHAIN))
def q_latest_advanced(spark, d):
    return rnd(sv.latest(advanced_of(spark, d), PORTFOLIO, 30), *ADV_ROUND)


@register("dashboard_series", wf(f"""select "date", total_value_gbp, {r('weighted_daily_return')}
                                     from portfolio_metrics where portfolio_id = '{PORTFOLIO}'
                                     order by "date" limit 100""", *o.METRIC_CHAIN))
def q_dashboard_series(spark, d):
    return rnd(sv.series(metrics_of(spark, d), PORTFOLIO, 100), "weighted_daily_return")


@register("serve_metrics", wf(f"""select {METRIC_SEL} from portfolio_metrics where portfolio_id = '{PORTFOLIO}'
                                  order by "date" desc limit 30""", *o.METRIC_CHAIN))
def q_serve_metrics(spark, d):
    return rnd(sv.metrics(metrics_of(spark, d), PORTFOLIO, 30), *METRIC_ROUND)


@register("serve_advanced", wf(f"""select {ADV_SEL} from advanced_metrics where portfolio_id = '{PORTFOLIO}'
                                   order by "date" desc limit 30""", *o.ADVANCED_CHAIN))
def q_serve_advanced(spark, d):
    return rnd(sv.advanced(advanced_of(spark, d), PORTFOLIO, 30), *ADV_ROUND)


@register("serve_dashboard", wf(f"""select cast("date" as varchar) as "date",
           case when total_value_gbp <> 0 then round(total_value_gbp, 2) end as value,
           case when weighted_daily_return <> 0 then round(weighted_daily_return, 4) end as "return"
    from (select * from portfolio_metrics where portfolio_id = '{PORTFOLIO}' order by "date" limit 100) z""",
                                *o.METRIC_CHAIN))
def q_serve_dashboard(spark, d):
    return sv.dashboard(metrics_of(spark, d), PORTFOLIO, 100)


@register("recent_queries", wf(f"""select query_id, total_elapsed_time, rows_produced, bytes_scanned
                                   from query_history where {HISTORY_WINDOW_SQL}
                                   order by start_time desc, query_id limit 20"""))
def q_recent_queries(spark, d):
    return prof.recent(history_of(spark, d), HISTORY_AS_OF, HISTORY_HOURS, 20)


TOP_SQL = f"""select query_id, user_name, cast(null as varchar) as warehouse_name,
           cast(null as varchar) as database_name, cast(null as varchar) as schema_name,
           total_elapsed_time / 1000 as elapsed_seconds, rows_produced,
           bytes_scanned / 1024 / 1024 / 1024 as scanned_gb, query_text
    from query_history where {HISTORY_WINDOW_SQL} and query_type = 'SELECT'
    order by bytes_scanned desc, elapsed_seconds desc, query_id limit 10"""


@register("top_expensive", wf(TOP_SQL))
def q_top_expensive(spark, d):
    return prof.top_expensive(history_of(spark, d), HISTORY_AS_OF, HISTORY_HOURS, 10)


# ------------------------------------------------------------------ 2.8 union
@register("union_feeds", wf("""select * from equity_daily where "date" <= date '1999-12-31'
    union all
    select symbol, "date", open, high, low, close + 0.25, volume, source from equity_daily
    where "date" > date '1999-12-31'"""))
def q_union_feeds(spark, d):
    e = fx.equity_daily(spark, d)
    a = e.filter(F.col("date") <= "1999-12-31")
    b = e.filter(F.col("date") >= "1999-07-01").withColumn("close", F.col("close") + 0.25)
    return cl.union_feeds(a, b)


# ------------------------------------------------------------------ 2.9 scalar functions
@register("scalar_null_handling", wf(f"""
    select symbol, "date", coalesce(company_name, 'UNKNOWN') as company_name, nullif(volume, 0) as volume,
           {r('case when daily_return < 0 then daily_return end', 'loss')},
           case when daily_return is null then 'none' when daily_return > 0 then 'up' else 'down' end as direction
    from fact_prices""", *o.PRICE_CHAIN))
def q_scalar_null_handling(spark, d):
    p = prices_of(spark, d)
    ret = F.col("daily_return")
    return rnd(p.select("symbol", "date", F.coalesce("company_name", F.lit("UNKNOWN")).alias("company_name"),
                        F.nullif(F.col("volume"), F.lit(0)).alias("volume"),
                        F.when(ret < 0, ret).alias("loss"),
                        F.when(ret.isNull(), "none").when(ret > 0, "up").otherwise("down").alias("direction")), "loss")


@register("scalar_dates", wf("""
    select symbol, "date", "date" + 1 as next_day, "date" - 29 as window_start, "date" - 30 as snapshot_from,
           strftime("date", '%Y-%m-%d') as date_text, cast(strftime("date", '%Y-%m-%d') as date) as parsed,
           cast(cast("date" as timestamp) - interval 1 hour as varchar) as hour_before
    from equity_daily"""))
def q_scalar_dates(spark, d):
    e = fx.equity_daily(spark, d)
    text = F.date_format("date", "yyyy-MM-dd")
    return e.select("symbol", "date", F.date_add("date", 1).alias("next_day"),
                    F.date_sub("date", 29).alias("window_start"), F.date_sub("date", 30).alias("snapshot_from"),
                    text.alias("date_text"), F.to_date(text, "yyyy-MM-dd").alias("parsed"),
                    (F.col("date").cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")).cast("string").alias("hour_before"))


@register("scalar_strings", wf("""
    select symbol, upper(company_name) as name_upper, length(company_name) as name_length,
           substring(company_name, 1, 8) as name_head, split_part(company_name, '#', 2) as name_number,
           length(trim(concat('  ', symbol, '  '))) as trimmed_length
    from dim_symbol"""))
def q_scalar_strings(spark, d):
    s = fx.dim_symbol(spark, d)
    return s.select("symbol", F.upper("company_name").alias("name_upper"),
                    F.length("company_name").cast("bigint").alias("name_length"),
                    F.substring("company_name", 1, 8).alias("name_head"),
                    F.split("company_name", "#").getItem(1).alias("name_number"),
                    F.length(F.trim(F.concat(F.lit("  "), "symbol", F.lit("  ")))).cast("bigint").alias("trimmed_length"))


@register("scalar_rounding", wf("""select portfolio_id, "date", round(total_value_gbp, 2) as value_2dp,
                                          round(weighted_daily_return, 4) as return_4dp from totals""", *o.METRIC_CHAIN))
def q_scalar_rounding(spark, d):
    dl = met.daily(met.holdings(prices_of(spark, d), positions_of(spark, d)))
    return dl.select("portfolio_id", "date", F.round("total_value_gbp", 2).alias("value_2dp"),
                     F.round("weighted_daily_return", 4).alias("return_4dp"))


@register("serve_nan_to_null", wf(f"""select portfolio_id, "date",
           case when day("date") = 1 then null else {'round(weighted_daily_return, 6)'} end as weighted_daily_return
    from portfolio_metrics""", *o.METRIC_CHAIN))
def q_serve_nan_to_null(spark, d):
    m = metrics_of(spark, d)
    nan = F.when(F.dayofmonth("date") == 1, F.lit(float("nan"))).otherwise(F.col("weighted_daily_return"))
    m = m.select("portfolio_id", "date", nan.alias("weighted_daily_return"))
    return rnd(sv.nan_to_none(m), "weighted_daily_return")


@register("format_rows", wf(f"""select concat_ws(' | ', 'query_id=' || cast(query_id as varchar),
           'rows_produced=' || cast(rows_produced as varchar), 'bytes_scanned=' || cast(bytes_scanned as varchar),
           'query_type=' || query_type) as line
    from query_history where {HISTORY_WINDOW_SQL}"""))
def q_format_rows(spark, d):
    h = src.history_window(history_of(spark, d), HISTORY_AS_OF, HISTORY_HOURS).select(
        "query_id", "rows_produced", "bytes_scanned", "query_type")
    return h.select(fc.format_rows(h).alias("line"))


# ------------------------------------------------------------------ 2.13 data quality / profiling
FX_FRESH = """select 'FX_DAILY_TODAY_CHECK' as task_name, case when n = 0 then 'FAIL' else 'PASS' end as status,
                     n as record_count, case when n = 0 then 'No FX data for today ({a})!' end as error_message
              from (select cast(count(*) filter (where "date" = date '{a}') as bigint) as n from fx_daily) z"""
EQ_FRESH = """select 'EQUITY_DAILY_TODAY_CHECK' as task_name, case when n = 0 then 'FAIL' else 'PASS' end as status,
                     n as record_count, case when n = 0 then 'No equities data for today ({a})!' end as error_message
              from (select cast(count(*) filter (where "date" = date '{a}') as bigint) as n from equity_daily) z"""
POS_CHECK = """select 'POSITIONS_CHECK' as task_name, case when n = 0 then 'FAIL' else 'PASS' end as status,
                      n as record_count,
                      case when n = 0 then 'No positions found in portfolio_positions_daily!' end as error_message
               from (select count(*) as n from positions_daily) z"""


@register("dq_freshness_fx", wf(FX_FRESH.format(a=AS_OF)))
def q_dq_freshness_fx(spark, d):
    return dq.freshness(fx.fx_daily(spark, d), "date", AS_OF, "FX_DAILY_TODAY_CHECK", "FX")


@register("dq_freshness_equity", wf(EQ_FRESH.format(a=AS_OF)))
def q_dq_freshness_equity(spark, d):
    return dq.freshness(fx.equity_daily(spark, d), "date", AS_OF, "EQUITY_DAILY_TODAY_CHECK", "equities")


@register("dq_positions_nonempty", wf(POS_CHECK, *o.POSITIONS))
def q_dq_positions_nonempty(spark, d):
    return dq.non_empty(positions_of(spark, d), "POSITIONS_CHECK", "portfolio_positions_daily")


def checks_of(spark, d):
    return dq.run_checks([
        dq.freshness(fx.fx_daily(spark, d), "date", AS_OF, "FX_DAILY_TODAY_CHECK", "FX"),
        dq.freshness(fx.equity_daily(spark, d), "date", AS_OF, "EQUITY_DAILY_TODAY_CHECK", "equities"),
        dq.non_empty(positions_of(spark, d), "POSITIONS_CHECK", "portfolio_positions_daily")], "fixture-run", AS_OF)


DQ_RESULTS_SQL = wf(f"""select 'fixture-run' as run_id, date '{AS_OF}' as run_date, * from (
    {FX_FRESH.format(a=AS_OF)} union all {EQ_FRESH.format(a=AS_OF)} union all {POS_CHECK}) z""", *o.POSITIONS)


@register("dq_results", DQ_RESULTS_SQL)
def q_dq_results(spark, d):
    return checks_of(spark, d)


@register("dq_alerts", wf(f"""select error_message as message from (
    {FX_FRESH.format(a=AS_OF)} union all {EQ_FRESH.format(a=AS_OF)} union all {POS_CHECK}) z
    where status = 'FAIL'""", *o.POSITIONS))
def q_dq_alerts(spark, d):
    return dq.alerts(checks_of(spark, d))


EQ_COLS = [("symbol", "string"), ("date", "date"), ("open", "double"), ("high", "double"), ("low", "double"),
           ("close", "double"), ("volume", "bigint"), ("source", "string")]


@register("dq_report", wf(" union all ".join(
    f"""select {i} as position, '{c}' as column_name, '{t}' as dtype,
               cast(count(*) - count("{c}") as bigint) as null_count,
               (select count(*) from equity_daily) as row_count,
               (select cast(coalesce(sum(n - 1), 0) as bigint) from
                  (select count(*) as n from equity_daily group by symbol, "date") z) as dupe_pk_rows
        from equity_daily""" for i, (c, t) in enumerate(EQ_COLS))))
def q_dq_report(spark, d):
    return dq.report(fx.equity_daily(spark, d), ["symbol", "date"])


@register("profile_history", wf(f"""
    select 'recent_queries' as report, concat_ws(' | ', 'query_id=' || cast(query_id as varchar),
           'total_elapsed_time=' || cast(total_elapsed_time as varchar), 'rows_produced=' || cast(rows_produced as varchar),
           'bytes_scanned=' || cast(bytes_scanned as varchar)) as line
    from (select * from query_history where {HISTORY_WINDOW_SQL} order by start_time desc, query_id limit 20) a
    union all
    select 'top_expensive', concat_ws(' | ', 'query_id=' || cast(query_id as varchar), 'user_name=' || user_name,
           'warehouse_name=None', 'database_name=None', 'schema_name=None',
           'elapsed_seconds=' || cast(elapsed_seconds as varchar), 'rows_produced=' || cast(rows_produced as varchar),
           'scanned_gb=' || cast(scanned_gb as varchar), 'query_text=' || query_text)
    from ({TOP_SQL}) b"""))
def q_profile_history(spark, d):
    return prof.profile_history(history_of(spark, d), HISTORY_AS_OF, HISTORY_HOURS)
