"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the rest.

The labelled URLs are those that a rule decides. The trees learn from a
bounded sample of them (``train_urls`` smallest hashes); the suffix
statistics they use are counted over all labelled URLs.

A null URL or one without ``://`` has an empty host and path, fits no rule and
is judged by the trees. Without any labelled URL the verdict is ``allow``.
Repeated rows are judged alike; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.trees import fit_trees

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SUFFIXES = 1024


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def features(url: pd.Series, host: pd.Series, path: pd.Series, rate: np.ndarray, slot: pd.Series) -> np.ndarray:
    """Lexical features; ``rate`` is the share of blocked URLs by slot of the host's last label."""
    rows = []
    for u, h, p in zip(url.fillna(""), host, path):
        counts = np.array([u.count(c) for c in set(u)], float) if u else np.ones(1)
        share = counts / counts.sum()
        query = u.partition("?")[2].partition("#")[0]
        digits = sum(c.isdigit() for c in u)
        rows.append((len(u), len(h), len(p), p.count("/"), h.count("."), digits, digits / max(1, len(u)),
                     -(share * np.log2(share)).sum(), query.count("&") + 1 if query else 0, "#" in u,
                     u.startswith("https"), u.count("-"), u.count("%"), p.endswith("/"),
                     len(p.rpartition("/")[2]), max(map(len, h.split(".")))))
    return np.column_stack([np.array(rows, float).reshape(len(url), -1), rate[slot.to_numpy(np.int64)]])


def judge_urls(pages: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES,
               train_urls: int = 20_000, rounds: int = 40, depth: int = 3, rate: float = 0.2) -> DataFrame:
    """``row`` (all columns of ``pages``), ``host``, ``path``, ``rule``, ``score`` (how likely blocked), ``verdict``."""
    spark = pages.sparkSession
    host, path = split_url(F.col(url_col))
    cut = pages.select(F.struct("*").alias("row"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = (cut.withColumn("rule", rule).withColumn("said", said)
             .withColumn("slot", F.expr(f"pmod(xxhash64(substring_index(host, '.', -1)), {SUFFIXES})")))
    known = ruled.filter(F.col("said").isNotNull()).select("url", "host", "path", "slot", (F.col("said") == "block").cast("int").alias("label"))
    by_slot = known.groupBy("slot").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).collect()  # SUFFIXES rows at most
    prior = sum(r["blocked"] for r in by_slot) / max(1, sum(r["n"] for r in by_slot))
    rates = np.full(SUFFIXES, prior)
    for r in by_slot:
        rates[r["slot"]] = (r["blocked"] + 10 * prior) / (r["n"] + 10)
    sample = known.orderBy(F.xxhash64("url"), "url").limit(train_urls).toPandas()
    model = None
    if sample["label"].nunique() == 2:
        model = fit_trees(features(sample["url"], sample["host"], sample["path"], rates, sample["slot"]),
                          sample["label"].to_numpy(), rounds, depth, rate)
    shared = spark.sparkContext.broadcast((model, rates, prior))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        trees, rates, prior = shared.value
        for u, h, p, s in batches:
            yield pd.Series(trees.predict(features(u, h, p, rates, s)) if trees else np.full(len(u), prior))

    judged = ruled.withColumn("score", score("url", "host", "path", "slot"))
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("row", "host", "path", "rule", "score", F.coalesce("said", own).alias("verdict"))
