"""Steps that grow no faster than their input: what is shuffled, staged and read twice."""

import pytest
from pyspark.sql import functions as F

from conftest import D
from riskframe.operators import positions as pos
from riskframe.plans import jobs
from riskframe.session import scratch_path
from riskframe.sinks import tables as sink
from riskframe.sources import payloads as pl
from riskframe.sources.files import folder_names
from riskframe.streaming import ingest
from riskframe.plans.store import Store
from test_plans import formatted

EQ = "symbol string, date date, close double"
GOOD = '{"Time Series (Daily)": {"2025-01-02": {"4. close": "1.5"}}}'


def tree(df) -> str:
    return formatted(df).split("\n\n")[0]


def test_grid_meets_its_deltas_without_a_shuffle(spark):
    t = spark.createDataFrame([("P1", "A", 2.0, D("2025-01-02")), ("P1", "A", 1.0, D("2025-01-04")), ("P1", None, 5.0, D("2025-01-03"))],
                              "portfolio_id string, symbol string, quantity_delta double, transaction_date date")
    grid = pos.matrix(pos.cross_spine(pos.pairs(t), "2025-01-01", "2025-01-05"), pos.deltas(t, "2025-01-01", "2025-01-05"))
    run = pos.running_quantity(grid)
    plan = tree(run)
    assert "Join" not in plan and "Exchange" not in plan[:plan.index("Generate")]
    rows = sorted((r.symbol or "", r.date.day, r.quantity) for r in run.collect())
    assert rows == [("", d, 0.0) for d in (2, 3, 4, 5)] + [("A", 2, 2.0), ("A", 3, 2.0), ("A", 4, 3.0), ("A", 5, 3.0)]


def test_days_of_few_pairs_are_generated_by_many_tasks(spark):
    t = spark.createDataFrame([(f"P{i}", "A", 1.0, D("2025-01-02")) for i in range(64)],
                              "portfolio_id string, symbol string, quantity_delta double, transaction_date date")
    for df in (pos.positions_daily(t, as_of="2025-01-05"), pos.cross_spine(pos.pairs(t), "2025-01-01", "2025-01-05")):
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_rows_of_new_partitions_join_nothing(spark):
    path = scratch_path(spark, "t-new")
    a = spark.createDataFrame([("S", D("2025-01-02"), 1.0)], EQ)
    b = spark.createDataFrame([("S", D("2025-02-03"), 5.0)], EQ)
    both = b.union(spark.createDataFrame([("S", D("2025-01-02"), 7.0)], EQ))
    plan = lambda u: sink.merge_plan(spark, path, u, ["symbol", "date"], a.schema, ("month",))[0]
    assert "Join" not in tree(plan(a))
    sink.upsert_table(spark, path, a, ["symbol", "date"], a.schema, partition_by=("month",))
    assert "Join" not in tree(plan(b))
    out = sink.upsert_table(spark, path, both, ["symbol", "date"], a.schema, partition_by=("month",))
    assert sorted(map(tuple, out.collect())) == [("S", D("2025-01-02"), 7.0), ("S", D("2025-02-03"), 5.0)]
    for bad, message in ((b.union(b), "more than once"), (spark.createDataFrame([(None, D("2025-03-03"), 1.0)], EQ), "null key symbol")):
        with pytest.raises(Exception, match=message):
            sink.upsert_table(spark, path, bad, ["symbol", "date"], a.schema, partition_by=("month",))
    assert out.count() == 2


def test_computed_rows_of_a_new_table_are_not_staged(spark):
    path = scratch_path(spark, "t-direct")
    seen = []
    a = spark.range(3).select(F.lit("S").alias("symbol"), F.date_add(F.lit("2025-01-30").cast("date"), F.col("id").cast("int")).alias("date"),
                              F.lit(1.0).alias("close"))
    merged, _ = sink.merge_plan(spark, path, a, ["symbol", "date"], a.schema, ("month",), unique=True)
    assert "Scan parquet" not in tree(merged) and "Exchange" not in tree(merged)
    out = sink.upsert_table(spark, path, a, ["symbol", "date"], a.schema, ("month",), unique=True, on_merge=lambda *sides: seen.append(sides))
    assert out.count() == 3 and len(seen) == 1 and seen[0][:2] == (None, None) and seen[0][2].count() == 3


def test_equity_documents_are_judged_as_they_are_loaded(spark, monkeypatch):
    judged = []
    whole = jobs.fail_on_rejects
    monkeypatch.setattr(jobs, "fail_on_rejects", lambda *r: (judged.extend(r), whole(*r)))
    docs = spark.createDataFrame([("A", GOOD), ("B", GOOD)], "symbol string, payload string")
    fx = spark.createDataFrame([("USDGBP", GOOD.replace("Series", "Series FX"))], "pair string, payload string")
    assert jobs.local_etl(spark, docs, fx, scratch_path(spark, "t-etl")).filter("row_count != 0").count() > 0
    assert len(judged) == 1       # the FX documents only
    for payload in ('{"Note": "limit"}', '{"Time Series (Daily)": {}}', None):
        bad = docs.union(spark.createDataFrame([(None, payload)], docs.schema))
        with pytest.raises(jobs.RejectedPayloads):
            jobs.local_etl(spark, bad, fx, scratch_path(spark, "t-etl"))


def test_ingest_judges_documents_as_it_loads_them(spark, monkeypatch):
    judged = []
    monkeypatch.setattr(jobs, "fail_on_rejects", lambda *r: judged.extend(r))
    base = scratch_path(spark, "t-ingest")
    spark.createDataFrame([("A", GOOD)], "symbol string, payload string").write.parquet(f"{base}/in/part=1")
    out = ingest.ingest(Store(spark, f"{base}/store"), "equities", f"{base}/in", f"{base}/work")
    assert out.count() == 1 and not judged


def test_duplicate_keys_are_dealt_by_the_row_count(spark, monkeypatch):
    from riskframe.operators import quality as dq
    monkeypatch.setattr(dq, "KEYS_PER_TASK", 50)
    df = spark.range(1000).selectExpr("case when id % 2 = 0 then 'HOT' when id % 5 = 0 then null else cast(id as string) end as k", "id % 3 as day", "id")
    want = 1000 - 3 - 3 - 400      # three days of HOT, three of null keys, 400 others
    dupes = dq.duplicate_rows(df, ["k", "day"])
    assert "REPARTITION_BY_NUM" in formatted(dupes) and dupes.first().dupe_pk_rows == want
    lines = dq.report(df, ["k", "day"]).collect()
    assert {(r.column_name, r.null_count, r.row_count, r.dupe_pk_rows) for r in lines} == {("k", 100, 1000, want), ("day", 0, 1000, want), ("id", 0, 1000, want)}
    assert dq.duplicate_rows(df.filter("id < 0"), "k").first().dupe_pk_rows == 0


def test_a_new_tree_is_published_by_one_rename(spark, monkeypatch):
    moved = []
    whole = sink.rename
    monkeypatch.setattr(sink, "rename", lambda s, path, to: (moved.append(to), whole(s, path, to)))
    root = scratch_path(spark, "t-tree")
    rows = lambda *r: spark.createDataFrame(r, "k string, v int")
    back = lambda: sorted(map(tuple, spark.read.schema("v int, k string").parquet(f"{root}/t").select("k", "v").collect()))
    sink.write_partitioned(rows(("a", 1), ("a", 2), ("b", 3), (None, 4)), root, "t", ["k"])
    assert moved == [f"{root}/t"] and back() == [("a", 1), ("a", 2), ("b", 3)]
    sink.write_partitioned(rows(("b", 5), ("c", 6)), root, "t", ["k"])        # only the partitions present are replaced
    assert moved == [f"{root}/t"] and back() == [("a", 1), ("a", 2), ("b", 5), ("c", 6)]
    assert folder_names(spark, root) == ["t"] and folder_names(spark, f"{root}/t") == ["k=a", "k=b", "k=c"]
    bad = rows(("d", 1)).selectExpr("k", "cast(raise_error('no') as int) as v")
    with pytest.raises(Exception, match="no"):
        sink.write_partitioned(bad, root, "u", ["k"])
    assert folder_names(spark, root) == ["t"]


def month_files(spark, store, table):
    return {m: folder_names(spark, f"{store.path(table)}/{m}") for m in folder_names(spark, store.path(table)) if m.startswith("month=")}


def test_a_merge_writes_only_what_differs(spark):
    """Rows that are stored already write nothing; new rows come beside the old files; an altered row packs its month again."""
    store = Store(spark, scratch_path(spark, "t-differs"))
    put = lambda *r: store.upsert("equity_daily", spark.createDataFrame(r, EQ))
    rows = lambda: sorted((r.symbol, r.date, float(r.close)) for r in store.read("equity_daily").collect())
    a1, a2, b1 = ("A", D("2025-01-02"), 1.0), ("A", D("2025-02-03"), 2.0), ("B", D("2025-01-02"), 3.0)
    put(a1, a2)
    first = month_files(spark, store, "equity_daily")
    logged = folder_names(spark, f"{store.root}/changes/log/equity_daily")
    put(a1, a2)
    store.upsert("equity_daily", spark.createDataFrame([], EQ))
    assert month_files(spark, store, "equity_daily") == first
    assert len(folder_names(spark, f"{store.root}/changes/log/equity_daily")) == len(logged) + 1     # none for no rows
    put(a1, a2, b1)
    second = month_files(spark, store, "equity_daily")
    assert set(second["month=2025-01"]) > set(first["month=2025-01"]) and second["month=2025-02"] == first["month=2025-02"]
    put(a1, a2, (*b1[:2], 4.0), ("B", D("2025-02-03"), 5.0), ("C", D("2025-03-03"), 6.0))
    third = month_files(spark, store, "equity_daily")
    assert not set(third["month=2025-01"]) & set(second["month=2025-01"]) and set(third["month=2025-02"]) > set(first["month=2025-02"])
    assert rows() == [a1, a2, ("B", D("2025-01-02"), 4.0), ("B", D("2025-02-03"), 5.0), ("C", D("2025-03-03"), 6.0)]
    with pytest.raises(Exception, match="null key symbol"):
        put((None, D("2025-01-03"), 1.0), ("D", D("2025-03-04"), 1.0))
    with pytest.raises(Exception, match="more than once"):
        put(("D", D("2025-01-03"), 1.0), ("D", D("2025-01-03"), 1.0), ("D", D("2025-03-04"), 1.0))
    assert len(rows()) == 5


def test_small_files_of_a_month_are_packed_again(spark, monkeypatch):
    monkeypatch.setattr(sink, "MOST_FILES", 3)
    store = Store(spark, scratch_path(spark, "t-packed"))
    n = []
    for i in range(5):
        store.upsert("equity_daily", spark.createDataFrame([("A", D(f"2025-01-0{i + 2}"), 1.0)], EQ))
        n.append(len(month_files(spark, store, "equity_daily")["month=2025-01"]))
    assert n == [1, 2, 3, 1, 2] and store.read("equity_daily").count() == 5


def test_computed_rows_are_appended_unless_they_are_stored(spark):
    store = Store(spark, scratch_path(spark, "t-computed"))
    put = lambda *r: store.upsert("fact_prices", spark.createDataFrame(r, EQ), unique=True, mostly_new=True)
    put(("A", D("2025-01-02"), 1.0), ("A", D("2025-02-03"), 2.0))
    first = month_files(spark, store, "fact_prices")
    put(("B", D("2025-01-02"), 3.0), ("A", D("2025-02-03"), 4.0), ("B", D("2025-02-03"), 5.0), ("B", D("2025-03-03"), 6.0))
    now = month_files(spark, store, "fact_prices")
    assert set(now["month=2025-01"]) > set(first["month=2025-01"]) and not set(now["month=2025-02"]) & set(first["month=2025-02"])
    assert sorted((r.symbol, r.date.month, float(r.close)) for r in store.read("fact_prices").collect()) == [
        ("A", 1, 1.0), ("A", 2, 4.0), ("B", 1, 3.0), ("B", 2, 5.0), ("B", 3, 6.0)]


def test_a_document_is_parsed_once(spark):
    docs = spark.createDataFrame([("A", GOOD), ("B", '{"Note": "limit"}')], "symbol string, payload string")
    path = scratch_path(spark, "t-docs")
    docs.write.parquet(path)
    docs = spark.read.schema(docs.schema).parquet(path)
    for chosen in (pl.payload_accepted, pl.payload_required):
        out = pl.parse_equity_payload(chosen(docs), "2025-01-01")
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("from_json(StructField(Time Series (Daily)") == 1, chosen
    assert [(r.symbol, r.close) for r in pl.parse_equity_payload(pl.payload_accepted(docs), "2025-01-01").collect()] == [("A", 1.5)]
    assert [tuple(r) for r in pl.payload_rejects(docs).collect()] == [("B", "rate_limited")]


def test_first_rows_carry_each_column_once(spark):
    from riskframe.operators import clean as cl
    df = spark.createDataFrame([("A", 2, "x"), ("A", 1, "z"), ("A", 1, "y"), ("B", None, None)], "k string, v int, w string")
    out = cl.dedupe_first(df, "k")
    assert "_row" not in formatted(out) and sorted(map(tuple, out.collect())) == [("A", 1, "y"), ("B", None, None)]


def test_documents_of_the_daily_inputs_are_built_once(spark):
    from conftest import SF_SMALL
    from riskframe.plans import catalog_io
    inputs = catalog_io._daily_inputs(spark, SF_SMALL, None)
    for docs in (inputs.equity_payloads, inputs.fx_payloads, inputs.benchmark_payloads):
        assert "Aggregate" not in tree(docs) and docs.count() > 0
