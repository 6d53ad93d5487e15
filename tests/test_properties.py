"""Property tests: batch = incremental, idempotent upsert, invariants."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.operators import advanced as adv
from riskframe.operators import metrics as met
from riskframe.operators import positions as pos
from riskframe.sinks import tables as sink

BASE = dt.date(2025, 1, 1)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

txn = st.tuples(st.sampled_from(["P1", "P2"]), st.sampled_from(["A", "B", "C"]),
                st.integers(-8, 8).map(lambda q: q / 4), st.integers(0, 20))


def txns_df(spark, rows):
    data = [(f"t{i}", p, s, q, BASE + dt.timedelta(days=d), "BUY") for i, (p, s, q, d) in enumerate(rows)]
    return spark.createDataFrame(data, "transaction_id string, portfolio_id string, symbol string, "
                                       "quantity_delta double, transaction_date date, transaction_type string")


@SETTINGS
@given(rows=st.lists(txn, min_size=1, max_size=25), cut=st.integers(0, 22))
def test_positions_batch_equals_incremental(spark, rows, cut):
    t = txns_df(spark, rows)
    as_of = BASE + dt.timedelta(days=22)
    full = pos.positions_daily(t, as_of=as_of)
    first_day = min(BASE + dt.timedelta(days=d) for *_, d in rows) - dt.timedelta(days=1)
    mid = max(first_day, BASE + dt.timedelta(days=cut) - dt.timedelta(days=1))
    part1 = pos.positions_daily(t, last_date=first_day, as_of=mid)
    part2 = pos.positions_daily(t, prior=part1, last_date=mid, as_of=as_of)
    assert sorted(full.collect()) == sorted(part1.unionByName(part2).collect())
    # the last quantity of each pair is the sum of its deltas up to as_of
    last = {(r.portfolio_id, r.symbol): r.quantity for r in full.filter(F.col("date") == as_of).collect()}
    sums = {}
    for p, s, q, _ in rows:
        sums[(p, s)] = sums.get((p, s), 0.0) + q
    assert last == sums


@SETTINGS
@given(keys=st.lists(st.integers(0, 30), min_size=1, max_size=30, unique=True),
       upd=st.lists(st.integers(0, 40), min_size=1, max_size=30, unique=True))
def test_upsert_idempotent_and_keeps_unmatched(spark, keys, upd):
    t = spark.createDataFrame([(k, float(k)) for k in keys], "k int, v double")
    u = spark.createDataFrame([(k, -float(k)) for k in upd], "k int, v double")
    once = sink.upsert(t, u, ["k"])
    twice = sink.upsert(once, u, ["k"])
    got = {r.k: r.v for r in once.collect()}
    assert sorted(once.collect()) == sorted(twice.collect())
    assert got == {**{k: float(k) for k in keys}, **{k: -float(k) for k in upd}}


values = st.lists(st.integers(1, 400).map(lambda v: v / 4), min_size=2, max_size=40)


@SETTINGS
@given(vals=values, parts=st.integers(1, 7))
def test_windows_invariant_to_partitioning_and_bounded(spark, vals, parts):
    rows = [("P", BASE + dt.timedelta(days=2 * i), v, (v - vals[i - 1]) / vals[i - 1] if i else None)
            for i, v in enumerate(vals)]
    d = spark.createDataFrame(rows, "portfolio_id string, date date, total_value_gbp double, "
                                    "weighted_daily_return double")
    a = sorted(met.rolling_var(d).collect())
    b = sorted(met.rolling_var(d.repartition(parts)).collect())
    assert a == b
    for r in a:       # VaR lies within min..max of its 30-day window
        window = [x[3] for x in rows if x[3] is not None and r.date - dt.timedelta(days=29) <= x[1] <= r.date]
        if window:
            assert min(window) - 1e-12 <= r.daily_var_95 <= max(window) + 1e-12
        else:
            assert r.daily_var_95 is None
    dd = adv.drawdown(adv.base(d)).collect()
    assert all(r.drawdown <= 0 for r in dd)         # peak > 0 here
