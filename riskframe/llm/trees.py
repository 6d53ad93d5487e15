"""Gradient-boosted regression trees for a binary label, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    base: float
    rate: float
    trees: list[tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]]  # per tree: (feature, cut) of each level, leaves

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for levels, leaves in self.trees:
            at = np.zeros(len(x), np.int64)
            for feature, cut in levels:
                at = 2 * at + (x[rows, feature[at]] > cut[at])
            margin += self.rate * leaves[at]
        return 1 / (1 + np.exp(-margin))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float, bins: int = 32, l2: float = 1.0) -> Trees:
    """Complete trees of ``depth`` levels; each node takes the cut of most gain, found on histograms."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)])
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(float(np.log(prior / (1 - prior))), rate, [])
    margin = np.full(n, model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        at, levels = np.zeros(n, np.int64), []
        for level in range(depth):
            nodes = 1 << level
            gain, feature, cut = np.zeros(nodes), np.zeros(nodes, np.int64), np.full(nodes, np.inf)
            for j in range(width):
                if not len(cuts[j]):
                    continue
                key = at * bins + binned[:, j]
                g, h = (np.bincount(key, w, nodes * bins).reshape(nodes, bins) for w in (grad, hess))
                gl, hl = g.cumsum(1)[:, :len(cuts[j])], h.cumsum(1)[:, :len(cuts[j])]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                won = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
                best = won.argmax(1)
                better = won[np.arange(nodes), best] > gain + 1e-9
                gain = np.where(better, won[np.arange(nodes), best], gain)
                feature, cut = np.where(better, j, feature), np.where(better, cuts[j][best], cut)
            levels.append((feature, cut))
            at = 2 * at + (x[np.arange(n), feature[at]] > cut[at])
        g, h = np.bincount(at, grad, 1 << depth), np.bincount(at, hess, 1 << depth)
        leaves = g / (h + l2)
        margin += rate * leaves[at]
        model.trees.append((levels, leaves))
    return model
