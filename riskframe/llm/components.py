"""Connected components by label propagation with pointer jumping, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """v, c: every vertex of ``edges`` (a long, b long) with the smallest vertex of its component.

    Each round a vertex takes the smallest label around it, then its label's
    label, so chains of n vertices take about log n rounds; every round is
    stored, so none depends on executors of an earlier one.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "cc-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("c")), "cc-labels")
    while True:
        near = (both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("c").alias("near")))
        met = (labels.join(near, labels["v"] == near["a"])
               .select("v", F.col("c").alias("old"), F.least("c", "near").alias("c")))
        jump = labels.select(F.col("v").alias("jv"), F.col("c").alias("jc"))
        new = stored(met.join(jump, met["c"] == jump["jv"])
                     .select("v", "old", F.least("c", "jc").alias("c")), "cc-labels")
        labels = new.select("v", "c")
        if new.filter("c <> old").isEmpty():
            return labels
