"""Write PLANS.md: the physical plan tree of each headline query and its operator counts.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Inputs are written to parquet first so each tree shows only the operator's own plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

OPS = ["Exchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "CartesianProduct",
       "BroadcastNestedLoopJoin", "Window", "Generate", "HashAggregate", "SortAggregate", "Scan parquet"]


def tree_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n")[0]


def main() -> None:
    from pyspark.sql import functions as F

    from riskframe.operators import advanced as adv
    from riskframe.operators import metrics as met
    from riskframe.operators import positions as pos
    from riskframe.operators import prices as prc
    from riskframe.plans import fixtures as fx
    from riskframe.session import get_session, scratch_path
    from riskframe.sinks import tables as sink

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    # the portfolio inputs as plain parquet tables (as a deployment would store them)
    root = scratch_path(spark, "plan-inputs")
    inputs = {}
    for n in ("equity_daily", "fx_daily", "dim_symbol", "portfolio_transactions", "fact_benchmark"):
        getattr(fx, n)(spark, sf_dir).write.parquet(f"{root}/{n}")
        inputs[n] = spark.read.parquet(f"{root}/{n}")
    prices = prc.fact_prices(inputs["equity_daily"], inputs["fx_daily"], inputs["dim_symbol"],
                             default_start=fx.DEFAULT_START)
    positions = pos.positions_daily(inputs["portfolio_transactions"], as_of=fx.AS_OF)
    metrics = met.portfolio_metrics(prices, positions)
    advanced = adv.advanced_metrics(metrics, inputs["fact_benchmark"])
    e = inputs["equity_daily"].select("symbol", "date", "close", "volume")
    path = scratch_path(spark, "plan-upsert")
    sink.upsert_table(spark, path, e.filter(F.col("date") <= "1999-06-30"), ["symbol", "date"], e.schema,
                      partition_by=("month",))
    merged, _ = sink.merge_plan(spark, path, e.filter(F.col("date") >= "1999-01-01"), ["symbol", "date"], e.schema,
                                partition_by=("month",))
    queries = {"fact_prices": prices, "positions_daily": positions, "portfolio_metrics": metrics,
               "advanced_metrics": advanced, "upsert (merge of the touched month partitions)": merged}

    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plan_report.py` from the portfolio inputs derived at `{sf_dir}` and stored as")
    print("parquet tables. Trees are the planned physical plans (`explain('formatted')`); at run time AQE may")
    print("still coalesce partitions, split skewed ones or turn a shuffle join into a broadcast on measured")
    print("sizes. Counts are operator nodes in the tree.\n")
    print("| query | " + " | ".join(OPS) + " |")
    print("|---|" + "---|" * len(OPS))
    trees = {}
    for name, df in queries.items():
        t = tree_of(df)
        trees[name] = t
        counts = [len(re.findall(rf"[-+] {re.escape(op)}\b", t)) for op in OPS]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
    for name, t in trees.items():
        print(f"\n## {name}\n\n```\n{t}\n```")


if __name__ == "__main__":
    main()
