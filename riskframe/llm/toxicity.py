"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as a word embedding (hashed) beside the mean embedding of its
character n-grams (hashed, with marks at both ends). Texts are read in
overlapping windows of ``WINDOW`` words that cover them wholly; in a window two
gated recurrent layers run both ways, attention pools their states, and one
logistic unit scores the pool. A text's score is that of its worst window.

Training: first every drawn window carries its text's label, then, round by
round, each text teaches by the window that the network thinks worst.

A null, empty or blank text scores 0. Repeated texts score alike. Without
labels of both classes every other score is the share of label 1 (0 without
any). Labels, languages, sources and ids are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.samples import Adam, examples, text_score

WINDOW, STRIDE = 32, 24
HIDDEN, DIM = 8, 12
WORD_SLOTS, GRAM_SLOTS = 4096, 8192
GRAMS = (3, 4, 5)
AT_ONCE = 8192  # windows that run together
WORDS_AT_ONCE = 1 << 15  # distinct words whose n-grams are gathered together


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.minimum(-x, 60)))


@dataclass
class Words:
    """Distinct words as hash slots: of the word, and of its n-grams (``start``: where each word's begin)."""

    word: np.ndarray
    gram: np.ndarray
    start: np.ndarray

    @staticmethod
    def of(words: list[bytes]) -> Words:
        parts = [Words.some(words[lo:lo + WORDS_AT_ONCE]) for lo in range(0, len(words), WORDS_AT_ONCE)]
        base = np.cumsum([0] + [len(p.gram) for p in parts[:-1]])
        return Words(np.concatenate([p.word for p in parts]), np.concatenate([p.gram for p in parts]),
                     np.concatenate([p.start + b for p, b in zip(parts, base)]))

    @staticmethod
    def some(words: list[bytes]) -> Words:
        marked = [b"<" + w + b">" for w in words]
        data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        size = np.array([len(w) for w in marked])
        owner, begin = np.repeat(np.arange(len(words)), size), np.cumsum(size) - size
        with np.errstate(over="ignore"):
            code, codes, owners = data.copy(), [], []
            for n in range(2, max(GRAMS) + 1):
                code = code[:-1] * np.uint64(1_000_003) + data[n - 1:] + np.uint64(n)
                if n in GRAMS:
                    own = owner[:len(code)] == owner[n - 1:]
                    codes.append(code[own])
                    owners.append(owner[:len(code)][own])
            # the whole word: sum of its bytes by place
            place = np.arange(len(data)) - begin[owner]
            mixed = (data + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93))
            whole = np.add.reduceat(mixed ^ mixed >> np.uint64(31), begin)
        slot = lambda x, n: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int32) % n
        owners, codes = np.concatenate(owners), np.concatenate(codes)
        order = np.argsort(owners, kind="stable")
        count = np.bincount(owners, minlength=len(words))  # every word has an n-gram: two marks and a byte
        return Words(slot(whole, WORD_SLOTS), slot(codes, GRAM_SLOTS)[order], np.cumsum(count) - count)

    def pick(self, some: np.ndarray) -> Words:
        end = np.append(self.start[1:], len(self.gram))
        n = end[some] - self.start[some]
        at = np.repeat(self.start[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return Words(self.word[some], self.gram[at], np.cumsum(n) - n)


def windows_of(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, windows as ids with -1 as padding, text of each window)."""
    split = [text.lower().encode().split() for text in texts]
    ids = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    rows, owner = [], []
    for k, listed in enumerate(split):
        own = np.array([*map(ids.__getitem__, listed)], np.int32)
        if not len(own):
            continue
        if len(own) <= WINDOW:
            rows.append(np.append(own, np.full(WINDOW - len(own), -1, np.int32))[None])
        else:
            starts = np.append(np.arange(0, len(own) - WINDOW, STRIDE), len(own) - WINDOW)
            rows.append(own[starts[:, None] + np.arange(WINDOW)])
        owner.append(np.full(len(rows[-1]), k))
    if not rows:
        return [], np.zeros((0, WINDOW), np.int32), np.zeros(0, np.int64)
    return list(ids), np.concatenate(rows), np.concatenate(owner)


@dataclass
class Network:
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        draw = lambda s, *shape: rng.normal(0, s, shape).astype(np.float32)
        p = {"word": draw(0.1, WORD_SLOTS, DIM), "gram": draw(0.3, GRAM_SLOTS, DIM), "pool": draw(0.3, 2 * HIDDEN),
             "out": draw(0.3, 2 * HIDDEN), "base": np.zeros(1, np.float32)}
        for way in "fb":
            p |= {f"{way}x": draw(0.3, 2 * DIM, 3 * HIDDEN), f"{way}h": draw(0.3, HIDDEN, 3 * HIDDEN), f"{way}c": np.zeros(3 * HIDDEN, np.float32)}
        return Network(p)

    def inputs(self, words: Words) -> np.ndarray:
        """Word and character part of each distinct word."""
        n, edge = len(words.word), np.append(words.start, len(words.gram))
        x = np.empty((n, 2 * DIM), self.p["word"].dtype)
        x[:, :DIM] = self.p["word"].take(words.word, 0)
        for lo in range(0, n, WORDS_AT_ONCE):
            own = edge[lo:lo + WORDS_AT_ONCE + 1]
            sums = np.add.reduceat(self.p["gram"].take(words.gram[own[0]:own[-1]], 0), own[:-1] - own[0])
            x[lo:lo + len(own) - 1, DIM:] = sums / np.diff(own)[:, None].astype(np.float32)
        return x

    def gates(self, x: np.ndarray) -> dict:
        """Input part of all gates, a column for each word; the last one is padding."""
        x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)]).T
        return {way: self.p[way + "x"].T @ x + self.p[way + "c"][:, None] for way in "fb"}

    def run(self, gates: dict, ids: np.ndarray, keep: bool = False):
        """Probability of each window; with ``keep`` also what the backward pass needs. States are columns."""
        p, n, H = self.p, len(ids), HIDDEN
        at = np.ascontiguousarray(np.where(ids < 0, gates["f"].shape[1] - 1, ids).T)
        states = np.empty((WINDOW, 2 * H, n), np.float32)
        trace = {"f": [None] * WINDOW, "b": [None] * WINDOW}
        for way, part in (("f", slice(0, H)), ("b", slice(H, 2 * H))):
            h, back = np.zeros((H, n), np.float32), np.ascontiguousarray(p[way + "h"].T)
            for t in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
                a, u = gates[way].take(at[t], 1), back @ h
                zr = sigmoid(a[:2 * H] + u[:2 * H])
                z, r = zr[:H], zr[H:]
                c = 2 * sigmoid(2 * (a[2 * H:] + r * u[2 * H:])) - 1
                if keep:
                    trace[way][t] = (h, z, r, c, u[2 * H:])
                h = c + z * (h - c)
                states[t, part] = h
        e = np.matmul(p["pool"], states)
        e = np.exp(e - e.max(0))
        share = e / e.sum(0)
        pooled = (share[:, None] * states).sum(0)
        prob = sigmoid(p["out"] @ pooled + p["base"])
        return (prob, states, share, pooled, trace) if keep else prob

    def windows(self, words: Words, ids: np.ndarray) -> np.ndarray:
        g = self.gates(self.inputs(words))
        return np.concatenate([self.run(g, ids[lo:lo + AT_ONCE]) for lo in range(0, len(ids), AT_ONCE)])

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        words, ids, owner = windows_of(texts)
        if len(words):
            np.maximum.at(out, owner, self.windows(Words.of(words), ids))
        return out

    def gradients(self, words: Words, ids: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted log loss of the windows; ``ids`` count within ``words``, -1 is padding."""
        p, H, n = self.p, HIDDEN, len(ids)
        x = self.inputs(words)
        prob, states, share, pooled, trace = self.run(self.gates(x), ids, keep=True)
        g = ((prob - y) * weight / n).astype(np.float32)
        grads = {"out": pooled @ g, "base": g.sum(keepdims=True)}
        gp = p["out"][:, None] * g
        dshare = (gp * states).sum(1)
        de = share * (dshare - (share * dshare).sum(0))
        ds = share[:, None] * gp + de[:, None] * p["pool"][:, None]
        grads["pool"] = (de[:, None] * states).sum((0, 2))
        flat = np.where(ids < 0, len(words.word), ids).T.ravel()
        order = np.argsort(flat, kind="stable")
        begin = np.searchsorted(flat[order], np.arange(len(words.word)))  # every word occurs
        xs, gx = x.T, 0
        for way, part in (("f", slice(0, H)), ("b", slice(H, 2 * H))):
            dh, du_h = np.zeros((H, n), np.float32), np.zeros((3 * H, H), np.float32)
            da_all = np.empty((WINDOW, 3 * H, n), np.float32)
            for t in range(WINDOW - 1, -1, -1) if way == "f" else range(WINDOW):
                h, z, r, c, uc = trace[way][t]
                dh = dh + ds[t, part]
                dc = dh * (1 - z) * (1 - c * c)
                da = da_all[t]
                da[:H] = dh * (h - c) * z * (1 - z)
                da[H:2 * H] = dc * uc * r * (1 - r)
                da[2 * H:] = dc
                du = np.concatenate([da[:2 * H], dc * r])
                du_h += du @ h.T
                dh = dh * z + p[way + "h"] @ du
            grads[way + "h"] = du_h.T
            grads[way + "c"] = da_all.sum((0, 2))
            by_word = np.add.reduceat(da_all.transpose(1, 0, 2).reshape(3 * H, -1).take(order, 1), begin, 1)
            if len(flat) and flat[order[-1]] == len(words.word):  # the last word's sum also took in the padding
                cut = np.searchsorted(flat[order], len(words.word))
                by_word[:, -1] -= da_all.transpose(1, 0, 2).reshape(3 * H, -1).take(order[cut:], 1).sum(1)
            grads[way + "x"] = xs @ by_word.T
            gx = gx + (p[way + "x"] @ by_word).T
        grads["word"] = np.zeros_like(p["word"])
        np.add.at(grads["word"], words.word, gx[:, :DIM])
        count = np.diff(np.append(words.start, len(words.gram)))
        spread = np.repeat(gx[:, DIM:] / count[:, None], count, 0)
        order = np.argsort(words.gram, kind="stable")
        slot, first = np.unique(words.gram[order], return_index=True)
        grads["gram"] = np.zeros_like(p["gram"])
        grads["gram"][slot] = np.add.reduceat(spread.take(order, 0), first)
        return grads


@dataclass
class Constant:
    value: float

    def score(self, texts: list[str]) -> np.ndarray:
        return np.array([self.value if t.split() else 0.0 for t in texts])


def fit_network(texts: list[str], labels: np.ndarray, prior: float, windows: int, rounds: int, rate: float, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    listed, ids, owner = windows_of(texts)
    words, net = Words.of(listed), Network.fresh(rng)
    adam = Adam(net.p, rate)
    share = labels.mean()
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share)).astype(np.float32)

    def teach(some: np.ndarray) -> None:
        for lo in range(0, len(some), 128):
            own = some[lo:lo + 128]
            used, at = np.unique(ids[own], return_inverse=True)
            at = at.reshape(len(own), WINDOW)
            if used[0] < 0:
                used, at = used[1:], at - 1
            adam.step(net.gradients(words.pick(used), at, labels[owner[own]], weight[owner[own]]))

    by_class = [np.flatnonzero(labels[owner] == k) for k in (0, 1)]
    for _ in range(2):
        draw = np.concatenate([rng.choice(c, min(len(c), windows // 4), replace=False) for c in by_class])
        teach(rng.permutation(draw))
    for _ in range(rounds):
        p = net.windows(words, ids)
        order = np.lexsort((-p, owner))
        first = np.unique(owner[order], return_index=True)[1]
        teach(rng.permutation(order[first]))
    return net


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic", per_class: int = 2000,
                 windows: int = 24_000, rounds: int = 6, rate: float = 0.01, seed: int = 7) -> Network | Constant:
    """A network fitted to a bounded sample of the labelled texts for which ``train`` holds."""
    sample = examples(docs, labels, label_col, train, per_class)
    sample = sample[sample["text"].map(lambda t: bool(t.encode().split())).astype(bool)]
    y = sample["label"].to_numpy(np.float32)
    if len(set(y)) < 2:
        return Constant(float(y.mean()) if len(y) else 0.0)
    told = labels.filter(F.col(label_col).isNotNull() & train).agg(F.avg(label_col)).first()[0]
    small = max(1, round(2000 / len(y)))
    return fit_network(sample["text"].tolist(), y, max(float(told), 0.2), windows, rounds * min(4, small), rate, seed)


def score_toxicity(docs: DataFrame, model: Network | Constant, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (replaced if there is one)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn("score", text_score(lambda texts: shared.value.score(texts))(F.col(text_col)))
