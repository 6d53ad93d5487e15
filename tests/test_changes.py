"""Change sets: tables built in several runs, in any order of arrival, equal those of a single run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import D
from riskframe.plans import changes
from riskframe.plans import incremental as inc
from riskframe.plans.store import Store
from riskframe.session import scratch_path
from riskframe.sources.files import folder_names, write_text

EQ = "symbol string, date date, close double, source string"
FX = "pair string, date date, rate double"
DIM = "symbol string, company_name string, currency string"
TXN = ("transaction_id string, portfolio_id string, symbol string, quantity_delta double, "
       "transaction_date date, transaction_type string")
DAYS = [dt.date(2025, 1, 2) + dt.timedelta(days=i) for i in range(0, 150, 2)]
AS_OF = "2025-06-05"


def equities():
    r = random.Random(3)
    return [(s, d, float(r.randint(50, 150)), "t") for s in "ABC" for d in DAYS]


def rates():
    return [("USDGBP", d, 0.5 + i % 5 / 10) for i, d in enumerate(DAYS)]


def trades():
    r = random.Random(4)
    return [(f"t{i}", f"P{i % 2}", "ABC"[i % 3], float(r.randint(1, 9)), DAYS[r.randrange(len(DAYS))], "BUY") for i in range(12)]


def put(spark, store, table, rows, schema):
    if rows:
        store.upsert(table, spark.createDataFrame(rows, schema))


def build(store, as_of=AS_OF):
    inc.build_prices(store)
    inc.build_positions(store, as_of)
    inc.build_advanced(store)


OUT = {"fact_prices": ["symbol", "date"], "portfolio_positions_daily": ["portfolio_id", "symbol", "date"],
       "portfolio_daily": ["portfolio_id", "date"], "fact_portfolio_metrics": ["portfolio_id", "date"],
       "fact_portfolio_adv_metrics": ["portfolio_id", "date"]}


def rows_of(store, table):
    t = store.read(table)
    cols = [F.round(F.col(c).cast("double"), 9).alias(c) if kind.startswith(("double", "decimal")) else F.col(c)
            for c, kind in t.dtypes if not c.startswith("_")]
    return sorted((tuple(r) for r in t.select(*cols).collect()), key=str)


def new_store(spark):
    return Store(spark, scratch_path(spark, "t-changes"))


@pytest.fixture(scope="module")
def single(spark):
    store = new_store(spark)
    put(spark, store, "equity_daily", equities(), EQ)
    put(spark, store, "fx_daily", rates(), FX)
    put(spark, store, "dim_symbol", [("A", "Alpha", "USD"), ("B", "Beta", "USD")], DIM)
    put(spark, store, "portfolio_transactions", trades(), TXN)
    put(spark, store, "fact_benchmark", [(d, "SPY", 400.0 + i) for i, d in enumerate(DAYS)], "date date, symbol string, close double")
    build(store)
    return {t: rows_of(store, t) for t in OUT}


def test_images_of_inserted_and_altered_rows(spark):
    schema = "k string, e string, d date, v double, _at string"
    t = spark.createDataFrame([("1", "a", D("2025-01-05"), 1.0, "x"), ("2", "a", D("2025-01-06"), 1.0, "x"),
                               ("3", "b", D("2025-01-07"), None, "x")], schema)
    u = spark.createDataFrame([("1", "a", D("2025-01-05"), 1.0, "y"),          # the same but for book-keeping
                               ("2", "c", D("2025-01-02"), 1.0, "y"),          # moved: both images
                               ("3", "b", D("2025-01-07"), None, "y"),         # nulls are equal
                               ("4", "d", D("2025-01-01"), 2.0, "y")], schema)
    got = sorted(tuple(r) for r in changes.images(t, u, ["k"], ["e", "d"]).collect())
    assert got == [("a", D("2025-01-06")), ("c", D("2025-01-02")), ("d", D("2025-01-01"))]
    only_new = changes.images(t, u, ["k"], ["e", "d"], update_cols=[]).collect()
    assert [tuple(r) for r in only_new] == [("d", D("2025-01-01"))]
    assert changes.images(t, u.limit(0), ["k"], ["e"]).count() == 0


def test_nothing_new_hands_on_nothing(spark):
    store = new_store(spark)
    for _ in range(2):
        put(spark, store, "equity_daily", equities()[:5], EQ)
    since = changes.pending(store, "fact_prices").since("equity_daily")
    assert [tuple(r) for r in since.collect()] == [("A", DAYS[0])]
    changes.pending(store, "fact_prices").done()
    assert changes.pending(store, "fact_prices").since("equity_daily").count() == 0
    put(spark, store, "equity_daily", equities()[:5], EQ)
    assert changes.pending(store, "fact_prices").since("equity_daily").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_equals_a_single_run(spark, single, seed):
    """Rows of every source are dealt to three runs at random: late symbols, days, rates, trades and names."""
    r = random.Random(seed)
    store = new_store(spark)
    put(spark, store, "fact_benchmark", [(d, "SPY", 400.0 + i) for i, d in enumerate(DAYS)], "date date, symbol string, close double")
    deal = {t: [(r.randrange(3), row) for row in rows] for t, rows in
            (("equity_daily", equities()), ("fx_daily", rates()), ("portfolio_transactions", trades()))}
    deal["dim_symbol"] = [(0, ("A", "Old name", "USD")), (1, ("B", "Beta", "USD")), (2, ("A", "Alpha", "USD"))]
    for run, as_of in enumerate(["2025-04-01", AS_OF, AS_OF]):
        for table, schema in (("equity_daily", EQ), ("fx_daily", FX), ("dim_symbol", DIM), ("portfolio_transactions", TXN)):
            put(spark, store, table, [row for at, row in deal[table] if at == run], schema)
        build(store, as_of)
    for t in OUT:
        assert rows_of(store, t) == single[t], t


def test_corrected_and_moved_rows(spark, single):
    """A price, a rate and three trades are wrong at first: one in its quantity, one in its symbol, one in its day."""
    store = new_store(spark)
    put(spark, store, "fact_benchmark", [(d, "SPY", 400.0 + i) for i, d in enumerate(DAYS)], "date date, symbol string, close double")
    eq, fx, tx = equities(), rates(), trades()
    put(spark, store, "equity_daily", eq[:40] + [(*eq[40][:2], 1.0, "t")] + eq[41:], EQ)
    put(spark, store, "fx_daily", fx[:60] + [(*fx[60][:2], 9.0)] + fx[61:], FX)
    put(spark, store, "dim_symbol", [("A", "Alpha", "USD"), ("B", "Beta", "USD")], DIM)
    wrong = [list(t) for t in tx]
    wrong[3][3] += 5
    wrong[5][2] = "A"
    wrong[7][4] = dt.date(2025, 6, 1)
    put(spark, store, "portfolio_transactions", [tuple(t) for t in wrong], TXN)
    build(store)
    assert rows_of(store, "fact_portfolio_metrics") != single["fact_portfolio_metrics"]
    put(spark, store, "equity_daily", [eq[40]], EQ)
    put(spark, store, "fx_daily", [fx[60]], FX)
    put(spark, store, "portfolio_transactions", tx, TXN)
    build(store)
    for t in OUT:
        assert rows_of(store, t) == single[t], t


def test_a_pair_that_lost_its_trades_keeps_zero_rows(spark):
    store = new_store(spark)
    put(spark, store, "portfolio_transactions", [("1", "P", "A", 2.0, D("2025-01-02"), "BUY"), ("2", "P", "B", 1.0, D("2025-01-02"), "BUY")], TXN)
    inc.build_positions(store, "2025-01-03")
    put(spark, store, "portfolio_transactions", [("1", "P", "B", 2.0, D("2025-01-02"), "BUY")], TXN)
    inc.build_positions(store, "2025-01-04")
    got = {(r.symbol, r.date.day): float(r.quantity) for r in store.read("portfolio_positions_daily").collect()}
    assert got == {("A", 2): 0.0, ("A", 3): 0.0, ("A", 4): 0.0, ("B", 2): 3.0, ("B", 3): 3.0, ("B", 4): 3.0}


def test_untouched_months_are_not_read(spark):
    """Files that cannot be read lie in every month before those that a run may need."""
    store = new_store(spark)
    eq = [("A", dt.date(2025, 1, 2) + dt.timedelta(days=i), 100.0 + i % 7, "t") for i in range(300)]
    put(spark, store, "equity_daily", eq[:295], EQ)
    put(spark, store, "fx_daily", [("USDGBP", d, 0.5) for _, d, *_ in eq], FX)
    put(spark, store, "portfolio_transactions", [("1", "P", "A", 1.0, D("2025-01-02"), "BUY")], TXN)
    inc.build_prices(store)
    inc.build_positions(store, "2025-10-23")
    inc.build_daily(store)
    spoiled = 0
    for table, upto in (("equity_daily", "2025-06"), ("fact_prices", "2025-10"), ("portfolio_positions_daily", "2025-10"),
                        ("portfolio_daily", "2025-10")):
        for month in folder_names(spark, store.path(table)):
            if month.startswith("month=") and "2025-01" < month[6:] < upto:
                write_text(spark, f"{store.path(table)}/{month}/spoiled.parquet", "no Parquet file")
                spoiled += 1
    assert spoiled > 20
    put(spark, store, "equity_daily", eq[295:], EQ)
    put(spark, store, "portfolio_transactions", [("2", "P", "A", 1.0, D("2025-10-20"), "BUY")], TXN)
    inc.build_prices(store)
    inc.build_positions(store, "2025-10-28")
    inc.build_daily(store)
    last = store.read("portfolio_daily", where="month = '2025-10'").orderBy(F.desc("date")).first()
    assert (last.date, last.total_value_gbp) == (dt.date(2025, 10, 28), 2 * (100 + 299 % 7) / 2)
