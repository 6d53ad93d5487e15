"""Hand-computed micro fixtures (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from conftest import D
from riskframe.operators import advanced as adv
from riskframe.operators import metrics as met
from riskframe.operators import positions as pos
from riskframe.operators import prices as prc


def approx(x, y, tol=1e-6):
    if x is None or y is None:
        return x is None and y is None
    return abs(x - y) <= tol


def rows(df, *cols):
    return {tuple(r[c] for c in cols[:2]): tuple(r[c] for c in cols[2:]) for r in df.collect()}


@pytest.fixture(scope="module")
def fact(micro):
    return prc.fact_prices(micro["equity"], micro["fx"], micro["dim"], default_start="2025-01-01")


def test_fact_prices(fact):
    got = rows(fact, "symbol", "date", "close_gbp", "daily_return", "rolling_7d_avg_close", "rolling_30d_volatility")
    expect = {("A", D("2025-01-02")): (50, None, 100, None), ("A", D("2025-01-03")): (55, 0.1, 105, 7.071068),
              ("A", D("2025-01-07")): (49.5, -0.1, 103, 6.082763), ("B", D("2025-01-02")): (100, None, 200, None),
              ("B", D("2025-01-03")): (100, 0, 200, 0), ("B", D("2025-01-07")): (110, 0.1, 206.666667, 11.547005)}
    assert set(got) == set(expect)          # 01-06 has no FX rate: the row is dropped
    for k, v in expect.items():
        assert all(approx(a, b) for a, b in zip(got[k], v)), (k, got[k], v)


def test_dim_left_join_keeps_unknown_symbols(fact):
    names = {r["symbol"]: r["company_name"] for r in fact.select("symbol", "company_name").distinct().collect()}
    assert names == {"A": "Alpha", "B": None}


def test_positions(micro):
    p = pos.positions_daily(micro["txns"], as_of="2025-01-07")
    got = {(r["symbol"], r["date"]): r["quantity"] for r in p.collect()}
    for day in range(1, 8):
        d = D(f"2025-01-0{day}")
        assert got[("A", d)] == (7.0 if day == 7 else 10.0)
        assert got[("B", d)] == (5.0 if day >= 3 else 0.0)
    assert len(got) == 14


def test_positions_literal_chain_agrees(micro):
    t = micro["txns"]
    start = pos.start_date(t)
    grid = pos.matrix(pos.cross_spine(pos.pairs(t), start, "2025-01-07"), pos.deltas(t, start, "2025-01-07"))
    a = sorted(pos.running_quantity(grid).collect())
    b = sorted(pos.positions_daily(t, as_of="2025-01-07").select("portfolio_id", "symbol", "date", "quantity")
               .collect())
    assert a == b


@pytest.fixture(scope="module")
def metrics(micro, fact):
    return met.portfolio_metrics(fact, pos.positions_daily(micro["txns"], as_of="2025-01-07"))


def test_portfolio_metrics(metrics):
    got = rows(metrics, "portfolio_id", "date", "total_value_gbp", "weighted_daily_return", "rolling_30d_volatility",
               "daily_var_95")
    expect = {("P1", D("2025-01-02")): (500, None, None, None),
              ("P1", D("2025-01-03")): (1050, 0.052381, None, 0.052381),
              ("P1", D("2025-01-07")): (896.5, 0.022699, 0.020988, 0.024183)}
    assert set(got) == set(expect)
    for k, v in expect.items():
        assert all(approx(a, b) for a, b in zip(got[k], v)), (k, got[k], v)


def test_advanced_metrics(micro, metrics):
    a = adv.advanced_metrics(metrics, micro["bench"])
    got = rows(a, "portfolio_id", "date", "sharpe_ratio", "sortino_ratio", "max_drawdown", "beta", "alpha")
    expect = {("P1", D("2025-01-02")): (0, 0, 0, None, None),
              ("P1", D("2025-01-03")): (0, 0, 0, 5.238095, 0),
              ("P1", D("2025-01-07")): (1.788646, 0, -0.146190, 1.484078, 0.037540)}
    for k, v in expect.items():
        assert all(approx(x, y) for x, y in zip(got[k], v)), (k, got[k], v)


def test_var_calendar_frame(spark):
    daily = spark.createDataFrame(
        [("P", D("2025-01-01"), -0.1), ("P", D("2025-01-02"), None), ("P", D("2025-01-20"), 0.3),
         ("P", D("2025-02-10"), 0.4)], "portfolio_id string, date date, weighted_daily_return double")
    got = [r["daily_var_95"] for r in met.rolling_var(daily).orderBy("date").collect()]
    assert all(approx(a, b) for a, b in zip(got, [-0.1, -0.1, -0.08, 0.305])), got


def test_incremental_prices_history_modes(micro):
    window = prc.fact_prices(micro["equity"], micro["fx"], micro["dim"], after="2025-01-03", history="window")
    inc = prc.fact_prices(micro["equity"], micro["fx"], micro["dim"], after="2025-01-03", history="increment")
    w = {r["symbol"]: r["daily_return"] for r in window.collect()}
    i = {r["symbol"]: r["daily_return"] for r in inc.collect()}
    assert set(w) == set(i) == {"A", "B"}
    assert approx(w["A"], -0.1) and i["A"] is None


def test_lookback_history_is_exact(micro):
    full = prc.fact_prices(micro["equity"], micro["fx"], micro["dim"], after="2025-01-03", history="window")
    bounded = prc.fact_prices(micro["equity"], micro["fx"], micro["dim"], after="2025-01-03", history="window",
                              lookback_days=2)
    assert sorted(full.collect()) == sorted(bounded.collect())


def test_watermark_frame_as_scalar_subquery(spark, micro):
    wm = spark.createDataFrame([(D("2025-01-03"),)], "last_loaded_date date")
    out = prc.fact_prices(micro["equity"], micro["fx"], micro["dim"], after=wm)
    assert {r["date"] for r in out.collect()} == {D("2025-01-07")}
    empty = spark.createDataFrame([], "last_loaded_date date")   # no watermark -> default start
    out2 = prc.fact_prices(micro["equity"], micro["fx"], micro["dim"], after=empty, default_start="2025-01-02")
    assert {r["date"] for r in out2.collect()} == {D("2025-01-03"), D("2025-01-07")}


def test_spine_never_reverses(spark):
    assert pos.date_spine(spark, "2025-01-07", "2025-01-07").count() == 0
    assert pos.date_spine(spark, "2025-01-09", "2025-01-07").count() == 0
    assert pos.date_spine(spark, "2025-01-05", "2025-01-07").count() == 2


def test_zero_total_gives_null_return(spark):
    h = spark.createDataFrame([("P", D("2025-01-02"), "A", 10.0, 0.1, 0.0, 0.0)],
                              "portfolio_id string, date date, symbol string, close_gbp double, daily_return double, "
                              "quantity double, position_value_gbp double")
    r = met.daily(h).collect()[0]
    assert r["total_value_gbp"] == 0 and r["weighted_daily_return"] is None


def test_null_return_stays_in_denominator(spark):
    h = spark.createDataFrame([("P", D("2025-01-02"), "A", 1.0, 0.1, 1.0, 100.0),
                               ("P", D("2025-01-02"), "B", 1.0, None, 1.0, 100.0)],
                              "portfolio_id string, date date, symbol string, close_gbp double, daily_return double, "
                              "quantity double, position_value_gbp double")
    assert approx(met.daily(h).collect()[0]["weighted_daily_return"], 0.05)


def test_covariance_counts_null_rows(spark):
    j = spark.createDataFrame([("P", D("2025-01-02"), 0.1, None), ("P", D("2025-01-03"), 0.2, 0.1),
                               ("P", D("2025-01-06"), 0.3, 0.3)],
                              "portfolio_id string, date date, portfolio_return double, benchmark_return double")
    last = adv.pair_stats(j).orderBy(F.col("date").desc()).first()
    n, sxy, sx, sy, syy = 3, 0.2 * 0.1 + 0.3 * 0.3, 0.6, 0.4, 0.1 ** 2 + 0.3 ** 2
    assert last["rolling_row_count"] == 3
    assert approx(last["covariance_30d"], (sxy - sx * sy / n) / (n - 1))
    assert approx(last["variance_30d"], (syy - sy * sy / n) / (n - 1))
