"""Quality classifier: a byte-level convolutional network in numpy.

Filters over runs of ``WIDTH`` bytes are maximised over overlapping chunks
(each two neighbouring blocks) that cover the whole text; the mean and the
maximum over the chunks feed one logistic unit. A filter over one-hot bytes is
a table per position, so a text is scored by table look-ups.

A null or empty text is one blank chunk. Repeated texts score alike. Without
labels of both classes every score is the share of label 1 (0.5 without any).
Labels, languages, sources and ids are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.samples import Adam, examples, text_score

WIDTH, FILTERS, BLOCK = 6, 16, 64
CROP = 32  # blocks of a text seen in one training step
RUN = 1 << 15  # positions convolved at once


@dataclass
class ByteNet:
    pairs: np.ndarray  # WIDTH / 2 tables of two bytes, FILTERS wide
    bias: np.ndarray
    head: np.ndarray
    base: float

    def blocks(self, text: str) -> np.ndarray:
        """Maximum of each filter in each block of the text."""
        data = text.encode()
        n = max(1, -(-len(data) // BLOCK))
        raw = np.zeros(n * BLOCK + WIDTH, np.uint8)
        raw[:len(data)] = np.frombuffer(data, np.uint8)
        two = raw[:-1].astype(np.intp) << 8 | raw[1:]
        out = np.empty((n, FILTERS), np.float32)
        for lo in range(0, n * BLOCK, RUN):
            hi = min(lo + RUN, n * BLOCK)
            x = self.pairs[0][two[lo:hi]]
            for j in range(1, WIDTH // 2):
                x += self.pairs[j][two[lo + 2 * j:hi + 2 * j]]
            out[lo // BLOCK:hi // BLOCK] = x.reshape(-1, BLOCK, FILTERS).max(1)
        return np.maximum(out + self.bias, 0)

    def score(self, texts: list[str]) -> list[float]:
        out = []
        for t in texts:
            b = self.blocks(t)
            chunks = np.maximum(b[:-1], b[1:]) if len(b) > 1 else b
            margin = np.r_[chunks.mean(0), chunks.max(0)] @ self.head + self.base
            out.append(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
        return out


@dataclass
class Constant:
    value: float

    def score(self, texts: list[str]) -> list[float]:
        return [self.value] * len(texts)


def fit_net(texts: list[str], labels: np.ndarray, epochs: int, rate: float, seed: int) -> ByteNet:
    rng = np.random.default_rng(seed)
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    params = {"table": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), "bias": np.zeros(FILTERS, np.float32),
              "head": rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32), "base": np.zeros(1, np.float32)}
    adam, size, batch = Adam(params, rate), CROP * BLOCK, 32
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for lo in range(0, len(order), batch):
            own = order[lo:lo + batch]
            raw, n = np.zeros((len(own), size + WIDTH), np.uint8), np.ones(len(own), np.int64)
            for i, k in enumerate(own):
                d = data[k]
                start = int(rng.integers(0, max(1, len(d) - size + 1))) // BLOCK * BLOCK  # another crop each time
                d = d[start:start + size + WIDTH]
                raw[i, :len(d)] = d
                n[i] = min(CROP, max(1, -(-len(d) // BLOCK)))
            x = params["table"][0][raw[:, :size]]
            for j in range(1, WIDTH):
                x += params["table"][j][raw[:, j:size + j]]
            x = x.reshape(len(own), CROP, BLOCK, FILTERS)
            top = x.argmax(2)
            b = np.maximum(np.take_along_axis(x, top[:, :, None], 2)[:, :, 0] + params["bias"], 0)
            second = b[:, 1:] > b[:, :-1]  # which block of a chunk holds its maximum
            chunk = np.maximum(b[:, 1:], b[:, :-1])
            live = np.arange(CROP - 1)[None] < np.maximum(1, n - 1)[:, None]
            alone = n == 1
            chunk[alone, 0], second[alone, 0] = b[alone, 0], False
            count = live.sum(1)[:, None]
            mean = (chunk * live[:, :, None]).sum(1) / count
            best = np.where(live[:, :, None], chunk, -1).argmax(1)
            peak = np.take_along_axis(chunk, best[:, None], 1)[:, 0]
            feats = np.concatenate([mean, peak], 1)
            p = 1 / (1 + np.exp(-np.clip(feats @ params["head"] + params["base"], -30, 30)))
            g = ((p - labels[own]) / len(own)).astype(np.float32)
            gf = g[:, None] * params["head"][None]
            gc = live[:, :, None] * (gf[:, None, :FILTERS] / count[:, None])
            np.put_along_axis(gc, best[:, None], np.take_along_axis(gc, best[:, None], 1) + gf[:, None, FILTERS:], 1)
            gb = np.zeros_like(b)
            gb[:, 1:] += gc * second
            gb[:, :-1] += gc * ~second
            gb *= b > 0
            at = top + (np.arange(CROP) * BLOCK)[None, :, None]
            table = np.zeros_like(params["table"])
            rows, filters = np.arange(len(own))[:, None, None], np.broadcast_to(np.arange(FILTERS), at.shape)
            for j in range(WIDTH):
                key = raw[rows, at + j].astype(np.int64) * FILTERS + filters
                table[j] = np.bincount(key.ravel(), gb.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            adam.step({"table": table, "bias": gb.sum((0, 1)), "head": feats.T @ g, "base": g.sum(keepdims=True)})
    t = params["table"]
    pairs = np.stack([(t[j][:, None] + t[j + 1][None]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)])
    return ByteNet(pairs, params["bias"], params["head"], float(params["base"][0]))


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", per_class: int = 1500,
                epochs: int = 10, rate: float = 0.01, seed: int = 5) -> ByteNet | Constant:
    """A network fitted to a bounded sample of the labelled texts for which ``train`` holds."""
    sample = examples(docs, labels, label_col, train, per_class)
    y = sample["label"].to_numpy(np.float32)
    if len(set(y)) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    return fit_net(sample["text"].tolist(), y, epochs if len(y) > 1000 else 4 * epochs, rate, seed)


def score_quality(docs: DataFrame, model: ByteNet | Constant, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (replaced if there is one)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn("score", text_score(lambda texts: shared.value.score(texts))(F.col(text_col)))


def held_out_accuracy(scored: pd.DataFrame, label: str) -> float:
    return float(((scored["score"] >= 0.5) == (scored[label] == 1)).mean())
