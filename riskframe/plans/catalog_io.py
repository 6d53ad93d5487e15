"""Catalog entries: payload sources, scans, sinks, incremental state, jobs, streaming.

Entries that write use a fresh folder under the session's shared folder
(``spark.checkpoint.dir``) and return what they read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import clean as cl
from ..operators import metrics as met
from ..operators import positions as pos
from ..operators import quality as dq
from ..operators import serving as sv
from ..schemas import as_double
from ..session import scratch_path
from ..sinks import tables as sink
from ..sources import files as src
from ..sources import payloads as pl
from ..streaming import ingest
from . import fixtures as fx
from . import incremental as inc
from . import jobs
from . import oracle_sql as o
from .catalog import (ADV_ROUND, METRIC_ROUND, PRICE_ROUND, advanced_of, metrics_of, positions_of, prices_of,
                      register, rnd)
from .catalog_ops import (D1, DQ_RESULTS_SQL, EQ_COLS as EQ_TYPES, EQ_FRESH, FX_FRESH, HISTORY_COLS, HISTORY_WINDOW_SQL,
                          POS_CHECK, checks_of, history_of)
from .fixtures import AS_OF, DEFAULT_START, HISTORY_AS_OF, HISTORY_HOURS, with_fixtures as wf
from .store import Store

START = "1996-01-01"
r = o.r
PRICE_SEL = ", ".join(r(c) if c in PRICE_ROUND else c for c in
                      ["symbol", "date", "company_name", "currency", "open", "high", "low", "close", "volume",
                       "usd_to_gbp", "close_gbp", "daily_return", "rolling_7d_avg_close", "rolling_30d_volatility"])
METRIC_SEL = ", ".join(r(c) if c in METRIC_ROUND else c for c in met.METRIC_COLUMNS)
ADV_SEL = ", ".join(r(c) if c in ADV_ROUND else c for c in
                    ["portfolio_id", "date", "sharpe_ratio", "sortino_ratio", "max_drawdown", "beta", "alpha"])
EQUITY_COLS = ["symbol", "date", "open", "high", "low", "close", "volume", "source"]


def _messy_symbol(c):
    """Lower-case and pad the keys of symbols ending in 7 (exercises normalisation)."""
    return F.when(F.col(c).endswith("7"), F.concat(F.lit(" "), F.lower(c), F.lit(" "))).otherwise(F.col(c))


# ------------------------------------------------------------------ 2.1 sources
@register("parse_equity_payload", wf(f"""select symbol, "date", open, high, low, close, volume,
                                         'alphavantage' as source from equity_daily where "date" >= date '{START}'"""))
def q_parse_equity_payload(spark, d):
    docs = pl.equity_payloads(fx.equity_daily(spark, d)).withColumn("symbol", _messy_symbol("symbol"))
    return pl.parse_equity_payload(docs, START)


@register("parse_benchmark_payload", wf(f"""select symbol, "date", close from fact_benchmark
                                            where "date" >= date '{START}'"""))
def q_parse_benchmark_payload(spark, d):
    bench = pl.benchmark_payloads(fx.fact_benchmark(spark, d)).withColumn("symbol", F.lit(" spy"))
    other = pl.benchmark_payloads(fx.equity_daily(spark, d))       # non-benchmark documents are ignored
    return pl.parse_benchmark_payload(bench.unionByName(other), START)


def fx_docs(spark, d):
    docs = pl.fx_payloads(fx.fx_daily(spark, d))
    docs = docs.withColumn("pair", F.when(F.col("pair") == "EURGBP", F.lit(" eurgbp ")).otherwise(F.col("pair")))
    bad = docs.filter(F.col("pair") == "USDGBP").withColumn("pair", F.lit("USD"))   # invalid pair: rejected
    return docs.unionByName(bad)


@register("parse_fx_payload", wf(f"""select pair, "date", rate, 'alphavantage' as source from fx_daily
                                     where "date" >= date '{START}'"""))
def q_parse_fx_payload(spark, d):
    return pl.parse_fx_payload(fx_docs(spark, d), START)


@register("filter_start_date", wf("""select pair, "date", rate, 'alphavantage' as source from fx_daily
                                     where "date" >= date '1999-03-15'"""))
def q_filter_start_date(spark, d):
    return pl.parse_fx_payload(fx_docs(spark, d), "1999-03-15")


@register("payload_rejects", wf("""
    select symbol, period, reason from (
      select symbol, strftime("date", '%Y-%m') as period,
             case month(min("date")) when 1 then 'empty' when 2 then 'rate_limited' when 3 then 'error'
                                     when 4 then 'missing_series' end as reason
      from equity_daily group by symbol, strftime("date", '%Y-%m')) z
    where reason is not null"""))
def q_payload_rejects(spark, d):
    docs = pl.equity_payloads(fx.equity_daily(spark, d))
    m = F.substring("period", 6, 2).cast("int")
    bad = (F.when(m == 1, F.lit("{}"))
           .when(m == 2, F.lit('{"Note": "API call frequency exceeded"}'))
           .when(m == 3, F.lit('{"Error Message": "Invalid API call"}'))
           .when(m == 4, F.lit('{"Meta Data": {"1. Information": "Daily Prices"}}'))
           .otherwise(F.col("payload")))
    return pl.payload_rejects(docs.withColumn("payload", bad))


def _write_csv(spark, df, name, cols):
    path = scratch_path(spark, name)
    df.select(*cols).write.option("header", True).csv(path)
    return path


TXN_COLS = schemas.TRANSACTION_COLUMNS


@register("scan_transactions_csv", wf("select * from portfolio_transactions"))
def q_scan_transactions_csv(spark, d):
    t = fx.portfolio_transactions(spark, d)
    path = _write_csv(spark, t, "txn-csv", list(reversed(TXN_COLS)))    # header order differs from the schema
    return as_double(src.read_transactions_csv(spark, path))


@register("scan_parquet", wf("select * from equity_daily"))
def q_scan_parquet(spark, d):
    root = scratch_path(spark, "scan")
    sink.write_parquet(fx.equity_daily(spark, d), root, "equity_daily")
    return src.read_table(spark, root, "equity_daily")


@register("scan_table", wf("select * from fx_daily"))
def q_scan_table(spark, d):
    root = scratch_path(spark, "scan")
    sink.write_parquet(fx.fx_daily(spark, d), root, "fx_daily")
    src.read_table(spark, root, "fx_daily").createOrReplaceTempView("riskframe_fx_daily")
    return spark.sql("SELECT * FROM riskframe_fx_daily")


@register("scan_query_history", wf(f"select {HISTORY_COLS} from query_history where {HISTORY_WINDOW_SQL}"))
def q_scan_query_history(spark, d):
    root = scratch_path(spark, "history")
    sink.write_parquet(fx.query_history(spark, d), root, "query_history")
    return src.history_window(src.read_history(spark, f"{root}/query_history"), HISTORY_AS_OF, HISTORY_HOURS)


@register("date_spine", wf("select * from calendar", *o.POSITIONS))
def q_date_spine(spark, d):
    return pos.date_spine(spark, pos.start_date(fx.portfolio_transactions(spark, d)), AS_OF)


@register("symbol_universe", wf("select * from equity_daily where symbol in ('S1', 'S7', 'S42', 'S99')"))
def q_symbol_universe(spark, d):
    return src.filter_universe(fx.equity_daily(spark, d), " S1, S7 ,, S42,S99 ")


# ------------------------------------------------------------------ 2.2 sinks
@register("write_parquet", wf(f"select {PRICE_SEL} from fact_prices", *o.PRICE_CHAIN))
def q_write_parquet(spark, d):
    root = scratch_path(spark, "sink")
    sink.write_parquet(prices_of(spark, d), root, "fact_prices")
    return rnd(src.read_table(spark, root, "fact_prices"), *PRICE_ROUND)


@register("write_partitioned", wf("""select * from equity_daily where not (symbol = 'S3' and day("date") = 1)"""))
def q_write_partitioned(spark, d):
    e = fx.equity_daily(spark, d)
    e = e.withColumn("symbol", F.when((F.col("symbol") == "S3") & (F.dayofmonth("date") == 1), F.lit(None))
                     .otherwise(F.col("symbol")))                           # null partition keys are dropped
    root = scratch_path(spark, "sink")
    sink.write_partitioned(e, root, "equity_daily", ["symbol"])
    return src.read_table(spark, root, "equity_daily", e.schema).select(*EQUITY_COLS)   # text keys stay text


@register("append_rows", wf("select * from equity_daily"))
def q_append_rows(spark, d):
    e = fx.equity_daily(spark, d)
    root = scratch_path(spark, "sink")
    n1 = sink.append(e.filter(F.col("date") <= D1), root, "equity_daily")
    n2 = sink.append(e.filter(F.col("date") > D1), root, "equity_daily")
    assert n1 > 0 and n2 > 0
    return src.read_table(spark, root, "equity_daily")


UPSERT_SQL = wf("""
    select coalesce(t.symbol, u.symbol) as symbol, coalesce(t."date", u."date") as "date",
           case when u.symbol is not null then u.close else t.close end as close,
           case when u.symbol is not null then u.volume else t.volume end as volume
    from (select symbol, "date", close, volume from equity_daily where "date" <= date '1999-06-30') t
    full outer join (select symbol, "date", close + 0.5 as close, volume + 1 as volume from equity_daily
                     where "date" >= date '1999-01-01') u
      on t.symbol = u.symbol and t."date" = u."date" """)


@register("upsert", UPSERT_SQL)
def q_upsert(spark, d):
    e = fx.equity_daily(spark, d).select("symbol", "date", "close", "volume")
    target = e.filter(F.col("date") <= "1999-06-30")
    updates = (e.filter(F.col("date") >= "1999-01-01")
               .select("symbol", "date", (F.col("close") + 0.5).alias("close"), (F.col("volume") + 1).alias("volume")))
    path = scratch_path(spark, "upsert")
    schema = target.schema
    sink.upsert_table(spark, path, target, ["symbol", "date"], schema)
    sink.upsert_table(spark, path, updates, ["symbol", "date"], schema)
    return sink.upsert_table(spark, path, updates, ["symbol", "date"], schema)   # applying twice changes nothing


@register("upsert_preserve", wf("""
    select coalesce(t.symbol, u.symbol) as symbol, coalesce(t."date", u."date") as "date",
           case when u.symbol is not null then u.close else t.close end as close,
           case when t.symbol is not null then t.loaded_on else date '2002-01-01' end as loaded_on
    from (select symbol, "date", close, "date" as loaded_on from equity_daily where "date" <= date '1999-06-30') t
    full outer join (select symbol, "date", close + 0.5 as close from equity_daily where "date" >= date '1999-01-01') u
      on t.symbol = u.symbol and t."date" = u."date" """))
def q_upsert_preserve(spark, d):
    e = fx.equity_daily(spark, d)
    target = e.filter(F.col("date") <= "1999-06-30").select("symbol", "date", "close",
                                                            F.col("date").alias("loaded_on"))
    updates = e.filter(F.col("date") >= "1999-01-01").select("symbol", "date", (F.col("close") + 0.5).alias("close"))
    return sink.upsert(target, updates, ["symbol", "date"], update_cols=["close"],
                       insert_defaults={"loaded_on": F.lit("2002-01-01").cast("date")})


@register("create_view", wf(f"select {METRIC_SEL} from portfolio_metrics", *o.METRIC_CHAIN))
def q_create_view(spark, d):
    v = met.register_view(spark, prices_of(spark, d), positions_of(spark, d), "view_portfolio_metrics")
    return rnd(v, *METRIC_ROUND)


@register("stage_replace", wf("select * from portfolio_transactions"))
def q_stage_replace(spark, d):
    store = Store(spark, scratch_path(spark, "store"))
    path = _write_csv(spark, fx.portfolio_transactions(spark, d), "txn-csv", TXN_COLS)
    inc.load_transactions(store, src.read_transactions_csv(spark, path))
    return as_double(store.read("portfolio_transactions")).select(*TXN_COLS)


@register("merge_transactions", wf("""select transaction_id, portfolio_id, symbol,
           case when transaction_type = 'SELL' then quantity_delta * 2 else quantity_delta end as quantity_delta,
           transaction_date, transaction_type from portfolio_transactions"""))
def q_merge_transactions(spark, d):
    store = Store(spark, scratch_path(spark, "store"))
    t = fx.portfolio_transactions(spark, d)
    first = _write_csv(spark, t.filter(F.col("transaction_date") <= D1), "txn-csv", TXN_COLS)
    inc.load_transactions(store, src.read_transactions_csv(spark, first))
    second = t.withColumn("quantity_delta", F.when(F.col("transaction_type") == "SELL", F.col("quantity_delta") * 2)
                          .otherwise(F.col("quantity_delta")))
    inc.load_transactions(store, src.read_transactions_csv(spark, _write_csv(spark, second, "txn-csv", TXN_COLS)))
    return as_double(store.read("portfolio_transactions")).select(*TXN_COLS)


@register("append_monitoring", DQ_RESULTS_SQL)
def q_append_monitoring(spark, d):
    store = Store(spark, scratch_path(spark, "store"))
    store.append("pipeline_monitoring", checks_of(spark, d).withColumn("_logged_at", F.current_timestamp()))
    return store.read("pipeline_monitoring").select(*dq.RESULT_COLUMNS)


@register("row_count_reconcile", wf("""select 'equity_daily' as table_name, count(*) as loaded_rows from equity_daily
                                       union all select 'fx_daily', count(*) from fx_daily"""))
def q_row_count_reconcile(spark, d):
    root = scratch_path(spark, "sink")
    n_eq = sink.append(fx.equity_daily(spark, d), root, "equity_daily")
    n_fx = sink.append(fx.fx_daily(spark, d), root, "fx_daily")
    return spark.createDataFrame([("equity_daily", n_eq), ("fx_daily", n_fx)], "table_name string, loaded_rows bigint")


SNAP_AS_OF = "2001-08-15"    # the last metric day of the fixtures is 2001-08-01
SNAP_SQL = wf(f"select {METRIC_SEL} from portfolio_metrics where \"date\" >= date '{SNAP_AS_OF}' - 30", *o.METRIC_CHAIN)


@register("snapshot_export", SNAP_SQL)
def q_snapshot_export(spark, d):
    root = scratch_path(spark, "snapshots")
    sink.write_parquet(sv.snapshot(metrics_of(spark, d), SNAP_AS_OF, 30), root, "portfolio_metrics")
    return rnd(src.read_table(spark, root, "portfolio_metrics"), *METRIC_ROUND)


@register("publish_snapshot", SNAP_SQL)
def q_publish_snapshot(spark, d):
    uri = scratch_path(spark, "published") + "/snapshots/portfolio_metrics"
    sv.publish(sv.snapshot(metrics_of(spark, d), SNAP_AS_OF, 30), uri)
    return rnd(spark.read.parquet(uri), *METRIC_ROUND)


# ------------------------------------------------------------------ 2.11 incremental state
def _two_batches(spark, feed, table, source, clean=None, date_col="date"):
    store = Store(spark, scratch_path(spark, "store"))
    inc.load_feed(store, feed.filter(F.col(date_col) <= D1), table, source, clean, date_col)
    inc.load_feed(store, feed, table, source, clean, date_col)
    return store


@register("get_watermark", wf("select max(\"date\") as last_loaded_date from equity_daily"))
def q_get_watermark(spark, d):
    store = _two_batches(spark, fx.equity_daily(spark, d), "equity_daily", "equities", cl.clean_equities)
    return inc.watermark(store.read("load_metadata"), "equities")


@register("set_watermark", wf(f"""select 'equities' as source, max("date") as last_loaded_date from equity_daily
                                  union all select 'positions_daily', date '{AS_OF}'"""))
def q_set_watermark(spark, d):
    store = Store(spark, scratch_path(spark, "store"))
    e = fx.equity_daily(spark, d)
    inc.set_watermark(store, "equities", inc.batch_max(e.filter(F.col("date") <= D1)))
    inc.set_watermark(store, "equities", inc.batch_max(e))
    inc.set_watermark(store, "positions_daily", D1)
    inc.set_watermark(store, "positions_daily", AS_OF)
    return store.read("load_metadata").select("source", "last_loaded_date")


@register("incremental_equities", wf("""select symbol, "date", open, high, low, close, volume, source
                                        from equity_daily"""))
def q_incremental_equities(spark, d):
    store = _two_batches(spark, fx.equity_daily(spark, d), "equity_daily", "equities", cl.clean_equities)
    return as_double(store.read("equity_daily")).select(*EQUITY_COLS)


@register("incremental_fx", wf("select pair, \"date\", rate from fx_daily"))
def q_incremental_fx(spark, d):
    store = _two_batches(spark, fx.fx_daily(spark, d), "fx_daily", "fx", cl.clean_fx)
    return as_double(store.read("fx_daily")).select("pair", "date", "rate")


@register("incremental_benchmark", wf("select \"date\", symbol, close from fact_benchmark"))
def q_incremental_benchmark(spark, d):
    store = _two_batches(spark, fx.fact_benchmark(spark, d), "fact_benchmark", "spy",
                         lambda b: cl.clean_equities(b, benchmark=True))
    return as_double(store.read("fact_benchmark")).select("date", "symbol", "close")


def _loaded_store(spark, d, upto=None):
    """A store holding the fixture's RAW tables (equity limited to ``upto``)."""
    store = Store(spark, scratch_path(spark, "store"))
    e = fx.equity_daily(spark, d)
    store.upsert("equity_daily", e if upto is None else e.filter(F.col("date") <= upto))
    store.upsert("fx_daily", fx.fx_daily(spark, d))
    store.upsert("dim_symbol", fx.dim_symbol(spark, d))
    store.upsert("fact_benchmark", fx.fact_benchmark(spark, d))
    store.upsert("portfolio_transactions", fx.portfolio_transactions(spark, d))
    return store


def _prices_table(store):
    return rnd(as_double(store.read("fact_prices")), *PRICE_ROUND)


@register("incremental_prices", wf(f"select {PRICE_SEL} from fact_prices", *o.PRICE_CHAIN))
def q_incremental_prices(spark, d):
    store = _loaded_store(spark, d, upto=D1)
    inc.build_prices(store, DEFAULT_START)
    store.upsert("equity_daily", fx.equity_daily(spark, d).filter(F.col("date") > D1))
    inc.build_prices(store, DEFAULT_START)
    return _prices_table(store)


@register("incremental_positions", wf("select * from positions_daily", *o.POSITIONS))
def q_incremental_positions(spark, d):
    store = _loaded_store(spark, d)
    inc.build_positions(store, D1)
    inc.build_positions(store, AS_OF)
    return as_double(store.read("portfolio_positions_daily")).select("portfolio_id", "symbol", "date", "quantity")


@register("merge_advanced", wf(f"select {ADV_SEL} from advanced_metrics", *o.ADVANCED_CHAIN))
def q_merge_advanced(spark, d):
    store = _loaded_store(spark, d)
    inc.build_prices(store, DEFAULT_START)
    inc.build_positions(store, AS_OF)
    inc.build_advanced(store)
    inc.build_advanced(store)            # a second full recompute merges onto the same keys
    return rnd(store.read("fact_portfolio_adv_metrics").select(*adv_cols()), *ADV_ROUND)


@register("advanced_by_increment", wf(f"select {ADV_SEL} from advanced_metrics", *o.ADVANCED_CHAIN))
def q_advanced_by_increment(spark, d):
    """Days, a late symbol and late benchmark days come in a second run, whose windows go on from stored state."""
    late = F.pmod(F.xxhash64("symbol"), F.lit(5)) == 0
    everything = fx.equity_daily(spark, d)
    store = Store(spark, scratch_path(spark, "store"))
    store.upsert("equity_daily", everything.filter((F.col("date") <= D1) & ~late))
    store.upsert("fx_daily", fx.fx_daily(spark, d))
    store.upsert("dim_symbol", fx.dim_symbol(spark, d))
    bench = fx.fact_benchmark(spark, d)
    early = (F.col("date") <= D1) & (F.dayofmonth("date") != 9)
    store.upsert("fact_benchmark", bench.filter(early))
    store.upsert("portfolio_transactions", fx.portfolio_transactions(spark, d))
    for as_of, rows in ((D1, None), (AS_OF, everything.filter((F.col("date") > D1) | late))):
        if rows is not None:
            store.upsert("equity_daily", rows)
            store.upsert("fact_benchmark", bench.filter(~early))
        inc.build_prices(store, DEFAULT_START)
        inc.build_positions(store, as_of)
        inc.build_advanced(store)
    return rnd(store.read("fact_portfolio_adv_metrics").select(*adv_cols()), *ADV_ROUND)


def adv_cols():
    return ["portfolio_id", "date", "sharpe_ratio", "sortino_ratio", "max_drawdown", "beta", "alpha"]


@register("ingest_available_now", wf("""select symbol, "date", open, high, low, close, volume,
                                        'alphavantage' as source from equity_daily"""))
def q_ingest_available_now(spark, d):
    base = scratch_path(spark, "stream")
    docs = pl.equity_payloads(fx.equity_daily(spark, d))
    store = Store(spark, scratch_path(spark, "store"))
    docs.filter(F.col("period") <= "1998-12").drop("period").write.parquet(f"{base}/in/part=1")
    ingest.ingest(store, "equities", f"{base}/in", f"{base}/work")
    docs.filter(F.col("period") > "1998-06").drop("period").write.parquet(f"{base}/in/part=2")   # overlaps the first
    docs.filter(F.col("period") > "2000-06").drop("period").write.parquet(f"{base}/in/part=3")   # and this the second
    ingest.ingest(store, "equities", f"{base}/in", f"{base}/work")
    out = ingest.ingest(store, "equities", f"{base}/in", f"{base}/work")     # nothing new
    return as_double(out).select(*EQUITY_COLS)


@register("to_json_records", wf(f"""select {METRIC_SEL} from (
    select *, row_number() over (partition by portfolio_id order by "date" desc) as place from portfolio_metrics) z
    where place <= 30""", *o.METRIC_CHAIN))
def q_to_json_records(spark, d):
    """V4 over the serving result of every portfolio. Number formats differ between
    engines, so the records are parsed back and compared as typed values."""
    m = sv.nan_to_none(sv.latest(metrics_of(spark, d), None, 30))
    back = F.from_json("json", schemas.VIEW_PORTFOLIO_METRICS).alias("r")
    return rnd(sv.to_json(m).select(back).select(*[F.col(f"r.{c}").alias(c) for c in met.METRIC_COLUMNS]), *METRIC_ROUND)


# ------------------------------------------------------------------ 2.15 jobs
def _arrived(spark, docs, name):
    """Vendor documents come as files: built once, whichever steps and runs read them."""
    path = scratch_path(spark, name)
    docs.write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def _daily_inputs(spark, d, csv_path):
    return jobs.DailyInputs(
        equity_payloads=_arrived(spark, pl.equity_payloads(fx.equity_daily(spark, d)), "equity-docs"),
        fx_payloads=_arrived(spark, pl.fx_payloads(fx.fx_daily(spark, d)), "fx-docs"),
        benchmark_payloads=_arrived(spark, pl.benchmark_payloads(fx.fact_benchmark(spark, d)), "benchmark-docs"),
        transactions_csv=csv_path, dim_symbol=fx.dim_symbol(spark, d),
        start_date="1990-01-01", default_start=DEFAULT_START)


@register("run_pipeline", wf(f"""select 'run-2' as run_id, date '{AS_OF}' as run_date, * from (
    {FX_FRESH.format(a=AS_OF)} union all {EQ_FRESH.format(a=AS_OF)} union all {POS_CHECK}) z""", *o.POSITIONS))
def q_run_pipeline(spark, d):
    """The whole chain, twice, the first time with a rate-limited and a broken document logged and held back:
    the checks logged by the second run."""
    root = scratch_path(spark, "warehouse")
    inputs = _daily_inputs(spark, d, _write_csv(spark, fx.portfolio_transactions(spark, d), "txn-csv", TXN_COLS))
    inputs.query_history = history_of(spark, d)
    eq = inputs.equity_payloads
    broken = (F.when(F.col("symbol").endswith("7"), F.lit('{"Note": "API call frequency exceeded"}'))
              .when(F.col("symbol").endswith("3"), F.lit('{"Time Series (Daily)": {"2001-08-01": "n/a"}}')).otherwise(F.col("payload")))
    inputs.equity_payloads = eq.withColumn("payload", broken)
    jobs.daily_run(spark, root, inputs, D1, run_id="run-1", on_reject="log")
    inputs.equity_payloads = eq
    jobs.daily_run(spark, root, inputs, AS_OF, snapshot_uri=f"{root}/snapshots/portfolio_metrics", run_id="run-2")
    store = Store(spark, root)
    return store.read("pipeline_monitoring").filter("run_id = 'run-2'").select(*dq.RESULT_COLUMNS)


@register("daily_run", wf(f"select {ADV_SEL} from advanced_metrics", *o.ADVANCED_CHAIN))
def q_daily_run(spark, d):
    root = scratch_path(spark, "warehouse")
    csv = _write_csv(spark, fx.portfolio_transactions(spark, d), "txn-csv", TXN_COLS)
    inputs = _daily_inputs(spark, d, csv)
    jobs.daily_run(spark, root, inputs, D1, run_id="run-1")
    out = jobs.daily_run(spark, root, inputs, AS_OF, snapshot_uri=f"{root}/snapshots/portfolio_metrics",
                         run_id="run-2")
    return rnd(out.select(*adv_cols()), *ADV_ROUND)


def _report_sql(table, keys, columns):
    return " union all ".join(f"""
        select '{table}' as table_name, {i} as position, '{c}' as column_name, '{t}' as dtype,
               cast(count(*) filter (where "{c}" is null) as bigint) as null_count, count(*) as row_count,
               cast(count(*) - count(distinct ({keys})) as bigint) as dupe_pk_rows
        from {table}_clean""" for i, (c, t) in enumerate(columns))


LOCAL_SQL = wf(_report_sql("equity_daily", 'symbol, "date"', [(c, "double" if c == "volume" else t) for c, t in EQ_TYPES]) + " union all "
               + _report_sql("fx_daily", 'pair, "date"', [("pair", "string"), ("date", "date"), ("rate", "double"), ("source", "string")]),
               ("equity_daily_clean", f"select * from equity_daily where \"date\" >= date '{START}'"),
               ("fx_daily_clean", f"select *, 'alphavantage' as source from fx_daily where pair = 'USDGBP' and \"date\" >= date '{START}'"))


@register("run_local_etl", LOCAL_SQL)
def q_run_local_etl(spark, d):
    out = scratch_path(spark, "processed")
    return jobs.local_etl(spark, pl.equity_payloads(fx.equity_daily(spark, d)), pl.fx_payloads(fx.fx_daily(spark, d)),
                          out, START)


@register("load_raw_files", wf("select symbol, \"date\", open, high, low, close, volume, source from equity_daily"))
def q_load_raw_files(spark, d):
    processed = scratch_path(spark, "processed")
    sink.write_parquet(fx.equity_daily(spark, d), processed, "equity_daily")
    sink.write_parquet(fx.fx_daily(spark, d), processed, "fx_daily")
    return jobs.load_raw(spark, processed, scratch_path(spark, "warehouse")).select(*EQUITY_COLS)
