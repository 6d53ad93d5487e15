"""Plan-shape tests (the scale properties) and catalog smoke tests."""

import datetime
import duckdb
import pytest

from conftest import SF_SMALL
from riskframe.operators import advanced as adv
from riskframe.operators import metrics as met
from riskframe.plans import catalog
from riskframe.plans import fixtures as fx


def formatted(df) -> str:
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def daily(spark):
    return met.daily(met.holdings(catalog.prices_of(spark, SF_SMALL), catalog.positions_of(spark, SF_SMALL)))


def test_var_uses_a_range_window_not_a_join(spark):
    d = spark.range(10).selectExpr("'P' as portfolio_id", "date_add(date'2025-01-01', cast(id as int)) as date",
                                   "id * 0.01 as weighted_daily_return")
    text = formatted(met.rolling_var(d))
    assert "Join" not in text and "CartesianProduct" not in text and "Window" in text


def test_metrics_windows_share_one_exchange(spark):
    d = spark.range(10).selectExpr("'P' as portfolio_id", "date_add(date'2025-01-01', cast(id as int)) as date",
                                   "id * 0.01 as weighted_daily_return", "id * 1.0 as total_value_gbp")
    text = formatted(adv.advanced_metrics(d.select("portfolio_id", "date", "total_value_gbp", "weighted_daily_return"),
                                          spark.range(10).selectExpr("'SPY' as symbol",
                                                                     "date_add(date'2025-01-01', cast(id as int)) as date",
                                                                     "100.0 + id as close")))
    # one exchange for the portfolio windows, one for the benchmark lag; one join (benchmark, by date)
    assert text.count("Exchange hashpartitioning(portfolio_id") <= 1
    tree = text.split("\n\n")[0]
    assert tree.count("Join") <= 1 and "CartesianProduct" not in tree and "SortMergeJoin" not in tree


def test_positions_do_not_join_the_dense_grid(spark):
    p = catalog.positions_of(spark, SF_SMALL)
    text = formatted(p)
    tree = text.split("\n\n")[0]
    assert "Join" not in tree and "CartesianProduct" not in tree and "Generate" in tree


def test_exploded_positions_are_never_broadcast(spark, daily):
    text = formatted(daily)
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text


def test_watermark_filter_reaches_the_scan(spark):
    from riskframe.plans import incremental as inc
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").selectExpr("cast(ts as date) as date", "value")
    meta = spark.createDataFrame([("equities", datetime.date(2024, 1, 15))],
                                 "source string, last_loaded_date date")
    text = formatted(inc.new_rows(e, meta, "equities"))
    assert "PushedFilters" in text and "ReadSchema: struct<ts" in text


def test_scans_prune_columns(spark):
    text = formatted(fx.equity_daily(spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate" in text


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["portfolio_id", "date", "total_value_gbp", "weighted_daily_return",
                          "rolling_30d_volatility", "daily_var_95"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"daily_run", "run_pipeline"}))
def test_no_oracle_is_empty(name):
    """A comparison of nothing with nothing proves nothing."""
    con = duckdb.connect()
    for t in ["supplier", "customer", "nation", "region", "part", "orders", "lineitem", "events"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    assert con.execute(f"select count(*) from ({catalog.ORACLE[name]}) z").fetchone()[0] > 0


@pytest.mark.parametrize("name", ["fact_prices", "positions_daily", "portfolio_metrics", "advanced_metrics",
                                  "clean_equities", "dedupe_first", "payload_rejects", "top_expensive",
                                  "latest_metrics_all", "union_feeds", "dq_report", "join_priors"])
def test_catalog_matches_duckdb_small(spark, name):
    con = duckdb.connect()
    for t in ["supplier", "orders", "lineitem", "events"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    want = sorted(tuple(str(v) for v in r) for r in con.execute(catalog.ORACLE[name]).fetchall())
    df = catalog.QUERIES[name](spark, SF_SMALL)
    cols = [d[0] for d in con.execute(catalog.ORACLE[name]).description]
    got = sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect())
    assert len(got) == len(want)
    assert got == want


def test_dedupe_pre_aggregates_a_hot_key(spark):
    """A key holding a third of the rows is reduced map-side before the shuffle."""
    from riskframe.operators import clean as cl
    df = spark.range(3000).selectExpr("case when id % 3 = 0 then 'HOT' else cast(id as string) end as symbol",
                                      "date'2025-01-02' as date", "cast(id as double) as close")
    out = cl.dedupe_first(df, ["symbol", "date"])
    text = formatted(out)
    tree = text.split("\n\n")[0]
    below_exchange = tree.split("Exchange", 1)[1]
    assert "Aggregate" in below_exchange          # partial aggregation under the exchange
    rows = {r.symbol: r.close for r in out.collect()}
    assert rows["HOT"] == 0.0 and len(rows) == 2001


def test_partitioned_write_rebalances(spark):
    from riskframe.session import scratch_path
    from riskframe.sinks import tables as sink
    df = spark.range(100).selectExpr("cast(id % 3 as string) as k", "id")
    root = scratch_path(spark, "t-rebalance")
    sink.write_partitioned(df, root, "t", ["k"])
    back = spark.read.schema("id long, k string").parquet(f"{root}/t")
    assert back.count() == 100 and {r.k for r in back.select("k").distinct().collect()} == {"0", "1", "2"}


def test_upsert_reads_only_touched_partitions(spark):
    """Unfiltered updates from Parquet: the merge target is listed and read in the updates' partitions only."""
    from pyspark.sql import functions as F
    from riskframe.session import scratch_path
    from riskframe.sinks import tables as sink
    path = scratch_path(spark, "t-prune")
    df = spark.range(400).selectExpr("concat('S', cast(id % 7 as string)) as symbol",
                                     "date_add(date'2020-01-01', cast(id as int)) as date", "cast(id as double) as close")
    sink.upsert_table(spark, path, df, ["symbol", "date"], df.schema, partition_by=("month",))
    late = f"{path}-updates"
    df.filter(F.col("date") >= "2021-01-01").withColumn("close", F.col("close") + 1).write.parquet(late)
    merged, pcols = sink.merge_plan(spark, path, spark.read.parquet(late), ["symbol", "date"], df.schema,
                                    partition_by=("month",))
    assert pcols == ["month"]
    text = formatted(merged)
    pruned = next(line for line in text.splitlines() if line.startswith("PartitionFilters: [") and "2021-01" in line)
    assert "2021-02" in pruned and "2020" not in pruned and "hashpartitioning(month" not in text
    assert merged.count() == 34          # the rows of the two months, of 400


def test_entry_imports_without_the_corpus_operators(tmp_path):
    """With the llm folders gone (with and without the pipeline file) the catalog is still served."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(f"{root}/riskframe", copy / "riskframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", copy)
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert 'portfolio_metrics' in q and set(o) <= set(q) and not any(k.startswith('op') and k[2:3].isdigit() for k in q) and 'pipeline' not in q")
    for with_pipeline in (False, True):
        if with_pipeline and os.path.exists(f"{root}/corpus_pipeline.py"):
            shutil.copy(f"{root}/corpus_pipeline.py", copy)
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
