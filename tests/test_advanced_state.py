"""Advanced metrics that go on from carried window state equal the full recompute."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import advanced as adv
from riskframe.plans import changes
from riskframe.plans import incremental as inc
from riskframe.plans.store import Store
from riskframe.schemas import as_double
from riskframe.session import scratch_path
from riskframe.sources.files import folder_names, write_text

DAILY = "portfolio_id string, date date, total_value_gbp double, weighted_daily_return double"
BENCH = "date date, symbol string, close double"
DAY0 = dt.date(2025, 1, 2)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def daily_rows(days=150):
    """P1 daily, P2 every fifth day, P3 late in the year, with null and zero values."""
    r = random.Random(11)
    out = []
    for i in range(days):
        for p, step, begin in (("P1", 1, 0), ("P2", 5, 0), ("P3", 1, 100)):
            if i >= begin and i % step == 0:
                value = None if r.random() < 0.05 else float(r.choice([70, 90, 100, 110, 130]) if i else 0)
                out.append((p, day(i), value, None if r.random() < 0.05 else r.uniform(-0.05, 0.05)))
    return out


def bench_rows(days=150):
    r = random.Random(12)
    return [(day(i), s, r.uniform(390, 410)) for i in range(days) if i % 3 != 1 for s in ("SPY", "QQQ")]


def put(spark, store, table, rows, schema):
    if rows:
        store.upsert(table, spark.createDataFrame(rows, schema))


def put_daily(spark, store, rows):
    """The daily table as ``build_daily`` leaves it; the metrics merge hands the change on."""
    put(spark, store, "portfolio_daily", rows, DAILY)
    inc.advance_watermark(store, "portfolio_daily", "portfolio_daily")


def rounded(df):
    cols = [F.round(c, 9).alias(c) for c in adv.ADV_COLUMNS[2:]]
    return sorted((tuple(r) for r in df.select("portfolio_id", "date", *cols).collect()), key=str)


def stored(store):
    return rounded(store.read("fact_portfolio_adv_metrics"))


def recomputed(store, benchmark="SPY"):
    return rounded(adv.advanced_metrics(store.read("fact_portfolio_metrics"), as_double(store.read("fact_benchmark")), benchmark))


def new_store(spark):
    return Store(spark, scratch_path(spark, "t-advanced"))


@pytest.mark.parametrize("seed,lookback", [(1, 10)])
def test_any_order_of_days_and_benchmark_equals_the_recompute(spark, seed, lookback):
    """Late days of a portfolio and late benchmark days; a look-back that is too short reads older state."""
    r = random.Random(seed)
    store = new_store(spark)
    daily = [(i // 50 if r.random() < 0.9 else r.randrange(3), row)
             for row in daily_rows() for i in [(row[1] - DAY0).days]]
    bench = [(i // 50 if r.random() < 0.9 else r.randrange(3), row)
             for row in bench_rows() for i in [(row[0] - DAY0).days]]
    for run in range(3):
        put_daily(spark, store, [row for at, row in daily if at == run])
        put(spark, store, "fact_benchmark", [row for at, row in bench if at == run], BENCH)
        inc.build_advanced(store, lookback_days=lookback)
        assert stored(store) == recomputed(store), run
    state = store.read("portfolio_adv_state")
    assert state.count() == len(daily)
    last = {x.portfolio_id: (x.row_no, x.bench_no) for x in state.filter(F.col("date") >= day(145)).orderBy("date").collect()}
    assert {p: n for p, (n, _) in last.items()} == {"P1": 150, "P2": 30, "P3": 50}
    assert last["P1"][1] == sum(1 for i in range(150) if i % 3 != 1)


def test_corrected_rows(spark):
    store = new_store(spark)
    daily, bench = daily_rows(), bench_rows()
    wrong = [(p, d, 500.0, x) if (p, d) == ("P1", day(40)) else (p, d, v, x) for p, d, v, x in daily]
    put_daily(spark, store, wrong)
    put(spark, store, "fact_benchmark", [(d, s, c + 50 * (d == day(60))) for d, s, c in bench], BENCH)
    inc.build_advanced(store)
    before = stored(store)
    put(spark, store, "portfolio_daily", [row for row in daily if row[:2] == ("P1", day(40))], DAILY)     # an all-history peak goes
    put(spark, store, "fact_benchmark", [row for row in bench if row[0] == day(60)], BENCH)
    inc.build_advanced(store)
    assert stored(store) == recomputed(store)
    changed = {(new[0], i) for old, new in zip(before, stored(store)) for i in range(2, 7) if old[i] != new[i]}
    assert {("P1", 4), ("P1", 5), ("P2", 5)} <= changed and ("P2", 4) not in changed     # drawdowns of P1, every beta


def test_another_benchmark_computes_all_days(spark):
    store = new_store(spark)
    put_daily(spark, store, daily_rows(60))
    put(spark, store, "fact_benchmark", bench_rows(60), BENCH)
    for benchmark in ("SPY", "QQQ", "SPY"):
        inc.build_advanced(store, benchmark)
        assert stored(store) == recomputed(store, benchmark), benchmark


def test_empty_tables(spark):
    store = new_store(spark)
    assert inc.build_advanced(store).count() == 0
    put(spark, store, "fact_benchmark", bench_rows(9), BENCH)
    put_daily(spark, store, daily_rows(9))
    assert inc.build_advanced(store).count() == len(daily_rows(9))
    assert stored(store) == recomputed(store)


def test_one_new_day_reads_the_look_back_and_rewrites_one_month(spark):
    store = new_store(spark)
    rows = [("P", day(i), 100.0 + i % 7, (i % 5 - 2) / 100) for i in range(302)]
    bench = [(day(i), "SPY", 400.0 + i % 11) for i in range(302)]
    put_daily(spark, store, rows[:300])
    put(spark, store, "fact_benchmark", bench[:300], BENCH)
    inc.build_advanced(store)
    put(spark, store, "portfolio_daily", [], DAILY)
    tables = {"fact_portfolio_adv_metrics": "2025-10", "portfolio_adv_state": "2025-08", "fact_benchmark": "2025-08"}
    files = {}
    for table, upto in tables.items():
        for month in folder_names(spark, store.path(table)):
            if month.startswith("month="):
                files[table, month] = sorted(folder_names(spark, f"{store.path(table)}/{month}"))
                if "2025-01" < month[6:] < upto:
                    write_text(spark, f"{store.path(table)}/{month}/spoiled.parquet", "no Parquet file")
                    files[table, month] = sorted([*files[table, month], "spoiled.parquet"])
    # the metrics of the new days, as build_metrics hands them on
    put_daily(spark, store, rows[300:])
    put(spark, store, "fact_benchmark", bench[300:], BENCH)
    inc.build_advanced(store)
    for (table, month), names in files.items():
        now = sorted(folder_names(spark, f"{store.path(table)}/{month}"))
        assert (now != names) == (month == "month=2025-10"), (table, month)
    full = adv.advanced_metrics(store.read("fact_portfolio_metrics"), spark.createDataFrame(bench, BENCH))
    got = store.read("fact_portfolio_adv_metrics", where="month = '2025-10'")
    assert rounded(got) == rounded(full.filter("date >= date '2025-10-01'"))
    assert changes.pending(store, "fact_portfolio_adv_metrics").since("fact_portfolio_metrics").count() == 0
