"""Bounded samples of labelled texts for the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longer texts are scored whole like any other, but never drawn as examples.
MAX_EXAMPLE_CHARS = 20_000
#: Characters of text that a task works on at once.
GROUP_CHARS = 6_000_000


def examples(docs: DataFrame, labels: DataFrame, label_col: str, train: Column, per_class: int,
             id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """text, label: at most ``per_class`` texts of each label value, those of smallest hash of the id.

    ``labels`` has ``id_col`` and ``label_col`` (an id labelled twice takes the larger label).
    """
    one = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train)
           .groupBy(id_col).agg(F.max(label_col).alias("label")))
    fit = docs.filter(F.length(text_col).between(1, MAX_EXAMPLE_CHARS))
    # hashes below a threshold for each label value (one row each): about twice as many as needed, as some have no usable text
    share = one.groupBy("label").agg((F.lit(2.0 * per_class) / F.count(F.lit(1))).alias("share"))
    rank = F.expr("pmod(xxhash64(id), 1073741824)")
    drawn = (one.select(F.col(id_col).alias("id"), "label").join(F.broadcast(share), "label")
             .withColumn("rank", rank).filter(F.col("rank") < F.col("share") * 1073741824).drop("share"))
    found = (fit.join(F.broadcast(drawn), fit[id_col] == drawn["id"])
             .select("id", "rank", "label", F.col(text_col).alias("text")).toPandas())
    found = found.sort_values(["label", "rank", "id", "text"], kind="stable").drop_duplicates("id")
    return found.groupby("label").head(per_class).reset_index(drop=True)[["text", "label"]]


def in_groups(texts: pd.Series, chars: int = GROUP_CHARS) -> Iterator[list[str]]:
    """The texts (null: empty) in runs of bounded size, a long text alone."""
    group, size = [], 0
    for t in texts:
        t = t if isinstance(t, str) else ""
        if group and size + len(t) > chars:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def text_score(score: Callable[[list[str]], list[float]]) -> Callable[[Column], Column]:
    """A column function that applies ``score`` to whole texts, a bounded group at a time."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[float] = []
            for group in in_groups(texts):
                out += map(float, score(group))
            yield pd.Series(out, dtype="float64")

    return run


class Adam:
    """Adam steps on a dict of arrays."""

    def __init__(self, params: dict, rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: v * 0 for k, v in params.items()}
        self.v = {k: v * 0 for k, v in params.items()}

    def step(self, grads: dict) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / ((self.v[k] / (1 - 0.99 ** self.t)) ** 0.5 + 1e-7)
