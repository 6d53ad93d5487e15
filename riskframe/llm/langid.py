"""Language identification by hierarchical discrimination.

Features are hashed byte n-grams (1 to 3) of the whole lower-cased text. A
first layer of linear support vector machines tells the language families
apart, then one-versus-one machines separate the languages of the family.

A null text or one without a letter is ``und`` with score 0; so is every text
when there is nothing to learn from. Languages outside ``FAMILIES`` are
families of their own. Repeated texts are judged alike; languages, sources and
ids are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.samples import examples, in_groups

FAMILIES = {"germanic": ("en", "de", "nl", "sv", "da", "no", "af"), "romance": ("fr", "es", "it", "pt", "ro", "ca"),
            "slavic": ("ru", "uk", "pl", "cs", "bg", "sr", "sk")}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
SLOTS = 4096
STEP = 1 << 20  # bytes counted at once


def vector(text: str) -> np.ndarray:
    """Unit vector of square-rooted n-gram counts."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    counts = np.zeros(SLOTS)
    for lo in range(0, len(data), STEP):
        x = data[lo:lo + STEP + 2].astype(np.uint32)
        new = min(STEP, len(data) - lo)
        for n in (1, 2, 3):
            if len(x) < n:
                continue
            code = x[:len(x) - n + 1].copy()
            for j in range(1, n):
                code = code * np.uint32(257) + x[j:len(x) - n + 1 + j]
            slot = (code * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(slot[:new], minlength=SLOTS)
    out = np.sqrt(counts)
    return out / np.linalg.norm(out)


def fit_svm(x: np.ndarray, y: np.ndarray, epochs: int = 30, l2: float = 1e-4, seed: int = 3) -> tuple[np.ndarray, float]:
    """Averaged Pegasos on the hinge loss; y in -1, 1, both classes weighted alike."""
    rng = np.random.default_rng(seed)
    weight = np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
    w, mean, t = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), 0
    one = np.column_stack([x, np.ones(len(x), x.dtype)])
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 32)):
            t += 1
            rate = 1 / (l2 * (t + 100 / l2 ** 0.5))
            push = (y[rows] * (one[rows] @ w) < 1) * y[rows] * weight[rows]
            w = (1 - rate * l2) * w + rate * (push @ one[rows]) / len(rows)
            mean += w if epoch >= epochs // 2 else 0
    mean /= (epochs - epochs // 2) * max(1, len(x) // 32)
    return mean[:-1], float(mean[-1])


@dataclass
class Duel:
    """One-versus-one machines among ``names``; the winner has most votes, ties go by the sum of margins."""

    names: list[str]
    machines: list[tuple[int, int, np.ndarray, float]]

    def choose(self, x: np.ndarray) -> tuple[str, float]:
        votes, margin = np.zeros(len(self.names)), np.zeros(len(self.names))
        for a, b, w, base in self.machines:
            m = float(w @ x + base)
            votes[a if m > 0 else b] += 1
            margin[a] += m
            margin[b] -= m
        best = max(range(len(self.names)), key=lambda i: (votes[i], margin[i]))
        spread = margin[best] / max(1, len(self.names) - 1)
        return self.names[best], 1.0 if not self.machines else float(1 / (1 + np.exp(-2 * spread)))


def fit_duel(x: np.ndarray, names: np.ndarray) -> Duel:
    known = sorted(set(names))
    machines = []
    for a, b in combinations(range(len(known)), 2):
        rows = (names == known[a]) | (names == known[b])
        machines.append((a, b, *fit_svm(x[rows], np.where(names[rows] == known[a], 1.0, -1.0))))
    return Duel(known, machines)


@dataclass
class Languages:
    families: Duel
    within: dict[str, Duel]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.within or not isinstance(text, str) or not any(map(str.isalpha, text)):
            return "und", 0.0
        x = vector(text)
        family, sure = self.families.choose(x)
        lang, own = self.within[family].choose(x)
        return lang, sure * own


def fit_languages(docs: DataFrame, train: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
                  per_lang: int = 600) -> Languages:
    """Machines fitted to at most ``per_lang`` texts of each language for which ``train`` holds."""
    sample = examples(docs.select(id_col, text_col), docs.select(id_col, lang_col), lang_col, train, per_lang, id_col, text_col)
    sample = sample[sample["text"].map(lambda t: any(map(str.isalpha, t))).astype(bool)]
    if not len(sample):
        return Languages(Duel([], []), {})
    x = np.empty((len(sample), SLOTS), np.float32)
    for i, t in enumerate(sample["text"]):
        x[i] = vector(t)
    langs = sample["label"].to_numpy()
    family = np.array([FAMILY_OF.get(lang, lang) for lang in langs])
    return Languages(fit_duel(x, family), {f: fit_duel(x[family == f], langs[family == f]) for f in sorted(set(family))})


def identify(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replaced if there are such)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [shared.value.predict(t) for group in in_groups(texts) for t in group]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    told = docs.withColumn("__told", run(F.col(text_col)))
    return told.withColumn("lang_pred", F.col("__told.lang_pred")).withColumn("score", F.col("__told.score")).drop("__told")
