"""Headline benchmark: prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (warm runs per query, default 5; the median is reported).

The headline queries run on the portfolio inputs derived once from the
each executed end to end with the no-op sink (every row produced, nothing
collected); one untimed warm-up run precedes the timed runs. ``e2e_*``
entries rebuild everything from the parquet files and are reported alongside
(not part of the headline value).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from riskframe.session import get_session, scratch_path  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = get_session(f"local[{cpus}]", app="riskframe-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g"})
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-bench-"))

    from riskframe.operators import advanced as adv
    from riskframe.operators import metrics as met
    from riskframe.operators import positions as pos
    from riskframe.operators import prices as prc
    from riskframe.plans import catalog
    from riskframe.plans import fixtures as fx
    from riskframe.sinks import tables as sink

    inputs = {name: getattr(fx, name)(spark, sf_dir).cache()
              for name in ("equity_daily", "fx_daily", "dim_symbol", "portfolio_transactions", "fact_benchmark")}
    for df in inputs.values():
        df.count()

    def prices():
        return prc.fact_prices(inputs["equity_daily"], inputs["fx_daily"], inputs["dim_symbol"],
                               default_start=fx.DEFAULT_START)

    def positions():
        return pos.positions_daily(inputs["portfolio_transactions"], as_of=fx.AS_OF)

    def metrics():
        return met.portfolio_metrics(prices(), positions())

    def advanced():
        return adv.advanced_metrics(metrics(), inputs["fact_benchmark"])

    def upsert_month():
        """The month-partitioned merge, the path of every fact table: six months of unfiltered updates from Parquet."""
        e = inputs["equity_daily"].select("symbol", "date", "close", "volume")
        path, late = scratch_path(spark, "bench-month"), scratch_path(spark, "bench-updates")
        e.filter(F.col("date") >= "2001-01-01").withColumn("close", F.col("close") + 0.5).write.parquet(late)
        sink.upsert_table(spark, path, e, ["symbol", "date"], e.schema, partition_by=("month",))
        run(sink.upsert_table(spark, path, spark.read.parquet(late), ["symbol", "date"], e.schema, partition_by=("month",)))

    def upsert():
        e = inputs["equity_daily"].select("symbol", "date", "close", "volume")
        target = e.filter(F.col("date") <= "1999-06-30")
        updates = e.filter(F.col("date") >= "1999-01-01").withColumn("close", F.col("close") + 0.5)
        path = scratch_path(spark, "bench-upsert")
        sink.upsert_table(spark, path, target, ["symbol", "date"], target.schema)
        sink.upsert_table(spark, path, updates, ["symbol", "date"], target.schema)
        run(sink.upsert_table(spark, path, updates, ["symbol", "date"], target.schema))

    times = {
        "fact_prices": timed(lambda: run(prices()), runs),
        "positions_daily": timed(lambda: run(positions()), runs),
        "portfolio_metrics": timed(lambda: run(metrics()), runs),
        "advanced_metrics": timed(lambda: run(advanced()), runs),
        "upsert": timed(upsert, runs),
        "upsert_month": timed(upsert_month, runs),
    }
    headline = round(sum(times.values()), 3)
    e2e_runs = max(1, runs // 2)
    times["e2e_advanced_metrics"] = timed(lambda: run(catalog.QUERIES["advanced_metrics"](spark, sf_dir)), e2e_runs)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": headline, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
