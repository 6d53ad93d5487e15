"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

Each source's target is turned into a whole number of blocks by highest
quotients, then each source's blocks are apportioned to its shards the same
way. In a shard the documents lie in seeded order on a line of words; the
shard's quota is a run of blocks on that line from a seeded start, going round
as often as the quota asks. A document's taken words are its overlap with that
run, so a source takes its quota of blocks exactly, and no document more than
``cap`` times its size.

A null text has size 0, a null source is a source of its own (last in order).
Repeated rows each count. All sizes 0 or an empty table: targets and taken
are 0. Other columns pass through; the order depends on doc_id, source, size
and seed only, so reruns agree.

Sources are read by the driver as one (name, size) row each; shards (one row
per ``shard_tokens`` words) are apportioned on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored, whole_text


def n_words(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def fill_targets(sizes: Sequence[int], weights: Sequence[float], cap: float) -> np.ndarray:
    """Shares of all sizes by weight, none above ``cap`` times its size; the excess is reshared by weight."""
    size, weight = np.asarray(sizes, float), np.asarray(weights, float)
    target, open_, left = np.zeros(len(size)), np.ones(len(size), bool), size.sum()
    while open_.any():
        share = left * weight / weight[open_].sum()
        full = open_ & (share > cap * size)
        if not full.any():
            target[open_] = share[open_]
            break
        target[full] = cap * size[full]
        left -= target[full].sum()
        open_ &= ~full
    return target


def sainte_lague(votes: Sequence[float], seats: int) -> np.ndarray:
    """Seats by the highest quotients votes / (1, 3, 5, ...); ties go to the earlier party.

    The quotient that wins the last seat is found by bisection, so the cost
    does not depend on the number of seats.
    """
    votes = np.asarray(votes, float)
    if not seats or not votes.sum():
        return np.zeros(len(votes), np.int64)
    won = lambda q: np.maximum(0, np.floor(votes / q / 2 + 0.5)).astype(np.int64)
    low, high = votes.sum() / seats / 8, votes.max() * 2
    while won(low).sum() < seats:
        low /= 2
    for _ in range(200):
        mid = (low + high) / 2
        if not low < mid < high:
            break
        if won(mid).sum() >= seats:
            low = mid
        else:
            high = mid
    got = won(high)  # fewer than all; the rest share the last quotient
    while (left := seats - got.sum()) > 0:
        order = np.argsort(-votes / (2 * got + 1), kind="stable")
        got[order[:min(left, int((votes > 0).sum()))]] += 1
    return got


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (1, 2, 3), cap: int = 3, block_tokens: int = 64,
                shard_tokens: int = 1 << 21, seed: int = 17) -> DataFrame:
    """``row`` (all columns of ``docs``), ``source``, ``size``, ``source_size``, ``target``, ``taken``.

    ``weights`` repeat over the sources in code point order, nulls last.
    """
    spark = docs.sparkSession
    sized = stored(docs.select(F.struct(*(c for c in docs.columns if c != text_col)).alias("row"),
                               F.col(source_col).cast("string").alias("source"),
                               F.col(id_col).alias("id"), n_words(F.col(text_col)).alias("size")), "mix-sizes")
    found = [(r["source"], r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    found.sort(key=lambda r: (r[0] is None, r[0]))
    targets = fill_targets([n for _, n in found], [weights[i % len(weights)] for i in range(len(found))], cap)
    blocks = sainte_lague(targets, round(sum(n for _, n in found) / block_tokens))
    plan = spark.createDataFrame(
        [(s, n, float(t), int(b), max(1, -(-n // shard_tokens))) for (s, n), t, b in zip(found, targets, blocks)],
        "name string, source_size long, target double, blocks long, shards long")
    key = F.xxhash64(F.lit(seed), F.col("id"))
    dealt = (sized.join(plan, F.col("source").eqNullSafe(F.col("name")))
             .withColumn("key", key).withColumn("shard", F.expr("pmod(key, shards)"))
             .withColumn("place", F.xxhash64("key", F.lit(seed + 1))))

    def apportion(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", ignore_index=True)
        quota = sainte_lague(pdf["length"], int(pdf["blocks"].iloc[0]))
        words = np.minimum(quota * block_tokens, cap * pdf["length"])
        return pd.DataFrame({"s_name": pdf["name"], "s_shard": pdf["shard"], "length": pdf["length"], "words": words})

    shards = dealt.groupBy("name", "shard", "blocks").agg(F.sum("size").alias("length"))
    quotas = shards.groupBy("name").applyInPandas(apportion, "s_name string, s_shard long, length long, words long")
    line = Window.partitionBy("name", "shard").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = (dealt.withColumn("end", F.sum("size").over(line))
            .join(quotas, F.col("name").eqNullSafe(F.col("s_name")) & (F.col("shard") == F.col("s_shard")))
            .withColumn("rounds", F.when(F.col("length") > 0, F.expr("words div length")).otherwise(F.lit(0)))
            .withColumn("run", F.col("words") - F.col("rounds") * F.col("length"))
            .withColumn("start", F.expr(f"pmod(xxhash64({seed}, s_name, s_shard), greatest(1, length div {block_tokens})) * {block_tokens}"))
            .withColumn("begin", F.col("end") - F.col("size")))

    def overlap(shift: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("end"), F.col("start") + F.col("run") - shift)
                          - F.greatest(F.col("begin"), F.col("start") - shift))

    taken = F.col("rounds") * F.col("size") + overlap(F.lit(0)) + overlap(F.col("length"))
    return laid.select("row", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
