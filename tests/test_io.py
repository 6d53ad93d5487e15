"""Payload parsing, cleaning, upsert, incremental state, quality and serving."""

import pytest
from pyspark.sql import functions as F

from conftest import D
from riskframe.operators import clean as cl
from riskframe.operators import quality as dq
from riskframe.operators import serving as sv
from riskframe.plans import incremental as inc
from riskframe.plans.store import Store
from riskframe.session import scratch_path
from riskframe.sinks import tables as sink
from riskframe.sources import files as src
from riskframe.sources import payloads as pl


def test_payload_round_trip_and_rejects(spark):
    good = ('{"Time Series (Daily)": {"2025-01-02": {"1. open": "1.5", "2. high": "2", "3. low": "1", '
            '"4. close": "1.75", "6. volume": "100"}, "2024-12-31": {"4. close": "9"}}}')
    docs = spark.createDataFrame([(" aapl ", good), ("MSFT", '{"Note": "limit"}'), ("GOOG", "{}"),
                                  ("IBM", '{"Error Message": "bad"}'), ("X", '{"Meta Data": {}}'), ("Y", None)],
                                 "symbol string, payload string")
    rows = pl.parse_equity_payload(pl.payload_accepted(docs), "2025-01-01").collect()
    assert [(r.symbol, r.date, r.open, r.close, r.volume, r.source) for r in rows] == [
        ("AAPL", D("2025-01-02"), 1.5, 1.75, 100, "alphavantage")]
    rej = {r.symbol: r.reason for r in pl.payload_rejects(docs).collect()}
    assert rej == {"MSFT": "rate_limited", "GOOG": "empty", "IBM": "error", "X": "missing_series", "Y": "empty"}


def test_fx_pair_rules(spark):
    doc = '{"Time Series FX (Daily)": {"2025-01-02": {"4. close": "0.8"}, "2025-01-03": {"4. close": "x"}}}'
    docs = spark.createDataFrame([(" usdgbp ", doc), ("USD", doc)], "pair string, payload string")
    out = pl.parse_fx_payload(docs, "2025-01-01").collect()
    assert {(r.pair, r.date, r.rate) for r in out} == {("USDGBP", D("2025-01-02"), 0.8),
                                                        ("USDGBP", D("2025-01-03"), None)}
    assert [r.reason for r in pl.payload_rejects(docs, pl.FX_SERIES, "pair").collect()] == ["invalid_pair"]
    cleaned = cl.clean_fx(pl.parse_fx_payload(docs, "2025-01-01")).collect()
    assert [(r.pair, r.rate) for r in cleaned] == [("USDGBP", 0.8)]       # bad rate dropped


def test_clean_equities(spark):
    df = spark.createDataFrame([("S", D("2025-01-02"), None, "5"), ("S", D("2025-01-03"), 1.0, "x"),
                                ("S", D("2025-01-03"), 2.0, "7"), ("S", D("2025-01-06"), 3.0, None)],
                               "symbol string, date date, close double, volume string")
    out = {(r.date, r.close, r.volume) for r in cl.clean_equities(df).collect()}
    assert out == {(D("2025-01-03"), 1.0, 0.0), (D("2025-01-06"), 3.0, 0.0)}
    bench = cl.clean_equities(df.drop("volume"), benchmark=True)
    assert bench.columns == ["symbol", "date", "close"]


def test_union_feeds_first_feed_wins(spark):
    a = spark.createDataFrame([("S", D("2025-01-02"), 1.0)], "symbol string, date date, close double")
    b = spark.createDataFrame([("S", D("2025-01-02"), 0.5), ("S", D("2025-01-03"), 2.0)],
                              "symbol string, date date, close double")
    assert sorted((r.date, r.close) for r in cl.union_feeds(a, b).collect()) == [
        (D("2025-01-02"), 1.0), (D("2025-01-03"), 2.0)]


def test_upsert_semantics(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    u = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = sink.upsert(t, u, ["k"])
    assert sorted(once.collect()) == sorted(spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], t.schema).collect())
    assert sorted(sink.upsert(once, u, ["k"]).collect()) == sorted(once.collect())
    dup = spark.createDataFrame([("b", 3), ("b", 5)], "k string, v int")
    with pytest.raises(Exception):
        sink.upsert(t, dup, ["k"]).collect()


def test_upsert_preserves_unset_columns(spark):
    t = spark.createDataFrame([("a", 1, D("2020-01-01"))], "k string, v int, created date")
    u = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    out = {r.k: (r.v, r.created) for r in sink.upsert(t, u, ["k"], update_cols=["v"],
                                                        insert_defaults={"created": F.lit(D("2030-01-01"))}).collect()}
    assert out == {"a": (9, D("2020-01-01")), "b": (2, D("2030-01-01"))}


def test_upsert_table_idempotent_and_partitioned(spark):
    path = scratch_path(spark, "t-upsert")
    schema = "symbol string, date date, close double"
    a = spark.createDataFrame([("S", D("2025-01-02"), 1.0), ("S", D("2025-02-03"), 2.0)], schema)
    b = spark.createDataFrame([("S", D("2025-02-03"), 5.0), ("T", D("2025-02-04"), 6.0)], schema)
    sink.upsert_table(spark, path, a, ["symbol", "date"], a.schema, partition_by=("month",))
    once = sorted(sink.upsert_table(spark, path, b, ["symbol", "date"], a.schema, partition_by=("month",)).collect())
    twice = sorted(sink.upsert_table(spark, path, b, ["symbol", "date"], a.schema, partition_by=("month",)).collect())
    assert once == twice == sorted(spark.createDataFrame(
        [("S", D("2025-01-02"), 1.0), ("S", D("2025-02-03"), 5.0), ("T", D("2025-02-04"), 6.0)], schema).collect())


def test_watermarks_and_incremental_load(spark):
    store = Store(spark, scratch_path(spark, "t-store"))
    feed = spark.createDataFrame([("S", D("2025-01-02"), 1.0, "1"), ("S", D("2025-01-03"), 2.0, "2")],
                                 "symbol string, date date, close double, volume string")
    assert inc.watermark(store.read("load_metadata"), "equities").collect()[0][0] is None
    inc.load_feed(store, feed.filter(F.col("date") <= "2025-01-02"), "equity_daily", "equities", cl.clean_equities)
    assert inc.watermark(store.read("load_metadata"), "equities").collect()[0][0] == D("2025-01-02")
    inc.load_feed(store, feed, "equity_daily", "equities", cl.clean_equities)
    inc.load_feed(store, feed, "equity_daily", "equities", cl.clean_equities)     # empty batch: no-op
    assert store.read("equity_daily").count() == 2
    assert inc.watermark(store.read("load_metadata"), "equities").collect()[0][0] == D("2025-01-03")


def test_transactions_csv_checks(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        src.read_transactions_csv(spark, str(tmp_path / "missing.csv"))
    p = tmp_path / "bad.csv"
    p.write_text("transaction_id,portfolio_id\n1,P1\n")
    with pytest.raises(ValueError):
        src.read_transactions_csv(spark, str(p))
    ok = tmp_path / "ok.csv"
    ok.write_text("symbol,transaction_id,portfolio_id,quantity_delta,transaction_date,transaction_type\n"
                  "A,1,P1,2.5,2025-01-02,BUY\n")
    r = src.read_transactions_csv(spark, str(ok)).collect()[0]
    assert (r.transaction_id, r.symbol, r.quantity_delta, r.transaction_date) == ("1", "A", 2.5, D("2025-01-02"))


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", D("2025-01-02"), None), ("a", D("2025-01-02"), 1.0)],
                               "k string, date date, v double")
    f = dq.freshness(df, "date", "2025-01-03", "T", "FX").collect()[0]
    assert (f.status, f.record_count, f.error_message) == ("FAIL", 0, "No FX data for today (2025-01-03)!")
    assert dq.freshness(df, "date", "2025-01-02", "T", "FX").collect()[0].status == "PASS"
    assert {r.column_name: r.null_count for r in dq.null_counts(df).collect()} == {"k": 0, "date": 0, "v": 1}
    assert dq.duplicate_rows(df, ["k", "date"]).collect()[0][0] == 1
    rep = dq.report(df, ["k", "date"]).collect()
    assert {r.column_name for r in rep} == {"k", "date", "v"} and all(r.row_count == 2 for r in rep)
    res = dq.run_checks([dq.freshness(df, "date", "2025-01-03", "T", "FX")], "run", "2025-01-03")
    assert [r.message for r in dq.alerts(res).collect()] == ["No FX data for today (2025-01-03)!"]
    with pytest.raises(Exception):
        dq.raise_on_fail(res).collect()


def test_serving(spark):
    df = spark.createDataFrame([("P1", D(f"2025-01-{d:02d}"), float(d), float("nan") if d == 3 else 0.01 * d)
                                for d in range(1, 10)] + [("P2", D("2025-01-01"), 0.0, 0.0)],
                               "portfolio_id string, date date, total_value_gbp double, weighted_daily_return double")
    latest = sv.metrics(df, "P1", 3).collect()
    assert [r.date.day for r in latest] == [9, 8, 7]
    assert sv.metrics(df, "P1", 9).filter(F.col("date") == "2025-01-03").collect()[0].weighted_daily_return is None
    assert sv.latest(df, None, 2).count() == 3
    dash = sv.dashboard(df, "P2", 100).collect()[0]
    assert (dash.date, dash.value, dash["return"]) == ("2025-01-01", None, None)
    assert sv.to_json(df.limit(1)).columns == ["json"]
    rec = sv.to_json(spark.createDataFrame([("P1", None)], "portfolio_id string, v double")).collect()[0].json
    assert rec == '{"portfolio_id":"P1","v":null}'                    # nulls kept, as the API returned them


def test_ensure_tables_never_replaces(spark):
    store = Store(spark, scratch_path(spark, "t-ddl"))
    made = store.ensure_tables()
    assert "fact_prices" in made and "load_metadata" in made
    store.upsert("dim_symbol", spark.createDataFrame([("A", "Alpha", "USD")], "symbol string, company_name string, "
                                                                              "currency string"))
    assert store.ensure_tables() == []
    assert store.read("dim_symbol").count() == 1
    assert store.read("fact_prices").schema["close_gbp"].dataType.simpleString() == "decimal(34,12)"


EQ_DOC = '{"Time Series (Daily)": {%s}}'


def eq_doc(**closes):
    return EQ_DOC % ", ".join(f'"{d[1:].replace("_", "-")}": {{"4. close": "{c}", "6. volume": "1.0"}}' for d, c in closes.items())


def test_stream_ingest_merges_overlapping_files_once(spark):
    from riskframe.streaming import ingest
    base = scratch_path(spark, "t-stream")
    store = Store(spark, f"{base}/store")

    def put(n, *docs):
        spark.createDataFrame(list(docs), "symbol string, payload string").coalesce(1).write.parquet(f"{base}/in/b={n}")

    put(1, ("A", eq_doc(d2025_01_02="1.5")))
    ingest.ingest(store, "equities", f"{base}/in", f"{base}/work")
    put(2, ("A", eq_doc(d2025_01_02="1.5", d2025_01_03="2.5")))
    put(3, ("A", eq_doc(d2025_01_03="9.9", d2025_01_06="3.5")))
    for _ in range(2):
        out = ingest.ingest(store, "equities", f"{base}/in", f"{base}/work")
    got = {(r.date, float(r.close)) for r in out.collect()}
    assert out.count() == 3 and (D("2025-01-02"), 1.5) in got and (D("2025-01-06"), 3.5) in got
    fx = '{"Time Series FX (Daily)": {"2025-01-02": {"4. close": "0.8"}}}'
    spark.createDataFrame([("USDGBP", fx)], "pair string, payload string").write.parquet(f"{base}/fx/b=1")
    assert ingest.ingest(store, "fx", f"{base}/fx", f"{base}/work-fx").count() == 1


def test_stream_ingest_fails_on_a_reject_and_loads_the_run_later(spark):
    from riskframe.plans.jobs import RejectedPayloads
    from riskframe.streaming import ingest
    base = scratch_path(spark, "t-stream")
    store = Store(spark, f"{base}/store")
    spark.createDataFrame([("A", eq_doc(d2025_01_02="1.5")), ("B", '{"Note": "x"}')],
                          "symbol string, payload string").write.parquet(f"{base}/in/b=1")
    for _ in range(2):       # the run stays staged and unloaded
        with pytest.raises(RejectedPayloads):
            ingest.ingest(store, "equities", f"{base}/in", f"{base}/work")
    assert inc.watermark(store.read("load_metadata"), "equities").collect()[0][0] is None


def test_stream_ingest_goes_past_a_logged_reject(spark):
    """B's first document is bad: logged once, A is loaded, later files too; B's good one gives prices for the same days."""
    from riskframe.streaming import ingest
    base = scratch_path(spark, "t-stream")
    store = Store(spark, f"{base}/store")
    fx = '{"Time Series FX (Daily)": {"2025-01-02": {"4. close": "0.5"}, "2025-01-03": {"4. close": "0.5"}}}'
    spark.createDataFrame([("USDGBP", fx)], "pair string, payload string").write.parquet(f"{base}/fx/b=1")
    ingest.ingest(store, "fx", f"{base}/fx", f"{base}/work-fx")
    days = {"d2025_01_02": "1.5", "d2025_01_03": "2.5"}
    files = [[("A", eq_doc(d2025_01_02="1.5")), ("B", '{"Note": "x"}')], [("A", eq_doc(**days))], [("B", eq_doc(**days))]]
    for n, docs in enumerate(files):
        spark.createDataFrame(docs, "symbol string, payload string").write.parquet(f"{base}/in/b={n}")
        out = ingest.ingest(store, "equities", f"{base}/in", f"{base}/work", on_reject="log")
        prices = inc.build_prices(store)
    both = [(s, d) for s in "AB" for d in (2, 3)]
    assert sorted((r.symbol, r.date.day) for r in out.collect()) == both
    assert sorted((r.symbol, r.date.day) for r in prices.collect()) == both
    logged = store.read("pipeline_monitoring").collect()
    assert [(r.run_id, r.task_name, r.error_message) for r in logged] == [
        ("equities-000000", "PAYLOAD_REJECT_EQUITIES", "B: rate_limited")]
    with pytest.raises(ValueError):
        ingest.ingest(store, "equities", f"{base}/in", f"{base}/work", on_reject="drop")


TXN = ("transaction_id string, portfolio_id string, symbol string, quantity_delta double, "
       "transaction_date date, transaction_type string")


def test_bucket_count_is_stored_with_the_table(spark):
    store = Store(spark, scratch_path(spark, "t-buckets"))
    t = spark.createDataFrame([(str(i), "P1", "A", 1.0, D("2025-01-02"), "BUY") for i in range(40)], TXN)
    inc.load_transactions(store, t)
    spark.conf.set("spark.riskframe.buckets.portfolio_transactions", "7")
    try:
        inc.load_transactions(store, t)      # the setting of an existing table changes nothing
        assert store.read("portfolio_transactions").count() == 40
        new = Store(spark, scratch_path(spark, "t-buckets"))
        inc.load_transactions(new, t)
        stored = spark.read.parquet(new.path("portfolio_transactions")).select("_bucket").distinct().collect()
        assert {r._bucket for r in stored} <= set(range(7)) and new.read("portfolio_transactions").count() == 40
    finally:
        spark.conf.unset("spark.riskframe.buckets.portfolio_transactions")


def test_partition_columns_of_a_table_cannot_change(spark):
    path = scratch_path(spark, "t-layout")
    a = spark.createDataFrame([("S", D("2025-01-02"), 1.0)], "symbol string, date date, close double")
    sink.upsert_table(spark, path, a, ["symbol", "date"], a.schema, partition_by=("month",))
    with pytest.raises(ValueError):
        sink.upsert_table(spark, path, a, ["symbol", "date"], a.schema)


def test_upsert_refuses_null_keys_and_keeps_null_partitions(spark):
    path = scratch_path(spark, "t-null")
    schema = "symbol string, date date, close double"
    a = spark.createDataFrame([("S", D("2025-01-02"), 1.0)], schema)
    sink.upsert_table(spark, path, a, ["symbol", "date"], a.schema, partition_by=("month",))
    spark.createDataFrame([("T", None, 2.0)], schema).write.parquet(f"{path}/month=__HIVE_DEFAULT_PARTITION__")
    for bad in ([("U", None, 3.0)], [("U", None, 3.0), ("U", None, 4.0)]):
        with pytest.raises(Exception, match="null key date"):
            sink.upsert_table(spark, path, spark.createDataFrame(bad, schema), ["symbol", "date"], a.schema, partition_by=("month",))
    out = sink.upsert_table(spark, path, a, ["symbol", "date"], a.schema, partition_by=("month",))
    assert {(r.symbol, r.close) for r in out.collect()} == {("S", 1.0), ("T", 2.0)}


def test_text_partition_keys_stay_text(spark):
    df = spark.createDataFrame([("0700", 1), ("0005", 2)], "symbol string, v int")
    root = scratch_path(spark, "t-text")
    sink.write_partitioned(df, root, "t", ["symbol"])
    back = src.read_table(spark, root, "t", df.schema)
    assert {r.symbol for r in back.collect()} == {"0700", "0005"}


def test_csv_quantity_keeps_its_digits(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("transaction_id,portfolio_id,symbol,quantity_delta,transaction_date,transaction_type\n"
                 "1,P1,A,123456789012.345678,2025-01-02,BUY\n")
    assert str(src.read_transactions_csv(spark, str(p)).first().quantity_delta) == "123456789012.345678"


def test_malformed_days_and_numbers(spark):
    one_bad = '{"Time Series (Daily)": {"2025-01-02": {"4. close": "1", "6. volume": "100.0"}, "2025-01-03": "oops"}}'
    docs = spark.createDataFrame([("A", one_bad), ("B", '{"Time Series (Daily)": []}'), ("C", eq_doc(dnoday="1")),
                                  ("D", eq_doc(d2025_01_02="2"))], "symbol string, payload string")
    assert {r.symbol: r.reason for r in pl.payload_rejects(docs).collect()} == {
        "A": "bad_day", "B": "bad_series", "C": "bad_day"}
    rows = pl.parse_equity_payload(docs.filter("symbol in ('A', 'D')"), "2025-01-01").filter("close is not null").collect()
    assert {(r.symbol, r.volume) for r in rows} == {("A", 100), ("D", 1)}


def _inputs(spark, docs, txns=None):
    from riskframe.plans.jobs import DailyInputs
    fx = '{"Time Series FX (Daily)": {"2025-01-02": {"4. close": "0.5"}, "2025-01-03": {"4. close": "0.5"}}}'
    spy = eq_doc(d2025_01_02="400", d2025_01_03="404")
    return DailyInputs(equity_payloads=spark.createDataFrame(docs, "symbol string, payload string"),
                       fx_payloads=spark.createDataFrame([("USDGBP", fx)], "pair string, payload string"),
                       benchmark_payloads=spark.createDataFrame([("SPY", spy)], "symbol string, payload string"),
                       transactions_csv=txns)


def test_rejected_payloads_lose_nothing(spark, tmp_path):
    """Day 1: B is rate-limited; day 2: both good with full history. All four rows are there afterwards."""
    from riskframe.plans import jobs
    root = scratch_path(spark, "t-run")
    day1 = [("A", eq_doc(d2025_01_02="1")), ("B", '{"Note": "slow down"}')]
    day2 = [(s, eq_doc(d2025_01_02="1", d2025_01_03="2")) for s in "AB"]
    with pytest.raises(jobs.RejectedPayloads, match="B: rate_limited"):
        jobs.daily_run(spark, root, _inputs(spark, day1), "2025-01-02")
    store = Store(spark, root)
    assert store.read("equity_daily").count() == 0 and store.read("load_metadata").count() == 0
    txns = tmp_path / "t.csv"
    txns.write_text("transaction_id,portfolio_id,symbol,quantity_delta,transaction_date,transaction_type\n"
                    "1,P1,A,2,2025-01-01,BUY\n2,P1,B,3,2025-01-01,BUY\n")
    jobs.daily_run(spark, root, _inputs(spark, day1, str(txns)), "2025-01-02", on_reject="log", run_id="r1")
    logged = store.read("pipeline_monitoring").filter("task_name like 'PAYLOAD%'").collect()
    assert [(r.task_name, r.error_message) for r in logged] == [("PAYLOAD_REJECT_EQUITIES", "B: rate_limited")]
    jobs.daily_run(spark, root, _inputs(spark, day2, str(txns)), "2025-01-03", snapshot_uri=f"{root}/snap", run_id="r2")
    assert store.read("equity_daily").count() == 4
    m = {(r.portfolio_id, r.date): r.total_value_gbp for r in store.read("fact_portfolio_metrics").collect()}
    assert m == {("P1", D("2025-01-02")): 2.5, ("P1", D("2025-01-03")): 5.0}      # B's first day, too
    assert store.read("fact_prices").count() == 4
    assert spark.read.parquet(f"{root}/snap").count() == 2


def test_ingest_keeps_a_symbol_that_comes_later(spark):
    from riskframe.streaming import ingest
    base = scratch_path(spark, "t-stream")
    store = Store(spark, f"{base}/store")
    for n, s in enumerate("AB"):
        spark.createDataFrame([(s, eq_doc(d2025_01_02="1", d2025_01_03="2"))], "symbol string, payload string").write.parquet(f"{base}/in/b={n}")
        out = ingest.ingest(store, "equities", f"{base}/in", f"{base}/work")
    assert sorted((r.symbol, r.date.day, float(r.close)) for r in out.collect()) == [("A", 2, 1.0), ("A", 3, 2.0), ("B", 2, 1.0), ("B", 3, 2.0)]


def test_raise_on_fail_fails_the_job_and_any_action(spark):
    from riskframe.plans import jobs
    root = scratch_path(spark, "t-fail")
    with pytest.raises(Exception, match="No positions found"):
        jobs.daily_run(spark, root, _inputs(spark, [("A", eq_doc(d2025_01_02="1"))]), "2025-01-02", raise_on_fail=True)
    store = Store(spark, root)
    assert "No positions found in portfolio_positions_daily!" in {r.message for r in store.read("pipeline_alerts").collect()}
    res = store.read("pipeline_monitoring")
    with pytest.raises(Exception):
        dq.raise_on_fail(res).count()
    with pytest.raises(Exception, match="NOT NULL column k"):
        dq.not_null(spark.createDataFrame([(None, 1)], "k string, v int"), ["k"]).count()


def test_default_symbol_universe(spark):
    df = spark.createDataFrame([("AAPL",), ("SPY",), ("GOOGL",)], "symbol string")
    assert {r.symbol for r in src.filter_universe(df).collect()} == {"AAPL", "GOOGL"}
    assert {r.symbol for r in src.filter_universe(df, " SPY ,").collect()} == {"SPY"}
