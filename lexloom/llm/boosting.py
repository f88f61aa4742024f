"""Histogram gradient-boosted trees for two classes, kept and applied as flat numpy arrays."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Forest:
    """Node ``i`` of tree ``t``: rows with feature ``feature[t, i]`` <= ``threshold[t, i]`` go to node
    ``2 i + 1``, the others to ``2 i + 2``; ``value[t, i]`` counts at the last level."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaf values: all rows step down one level at a time."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 2 - (x[rows, feature[node]] <= threshold[node])
            total += value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cut points of each feature at its quantiles; a feature of one value has none."""
    cuts = []
    for column in x.T:
        points = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
        cuts.append(points[points < column.max()])
    return cuts


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
        ridge: float = 2.0, least: float = 1.0) -> Forest:
    """Log-loss boosting. With one class, or without rows, the forest is the constant prior."""
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    nodes = 2 ** (depth + 1) - 1
    forest = Forest(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)), float(np.log(prior / (1 - prior))), depth)
    if len(y) == 0 or y.min() == y.max():
        return forest
    cuts = bin_edges(x, bins)
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    width, margin, kept = bins + 1, np.full(len(y), forest.base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            gain = np.zeros(count)
            cut = np.full(count, -1)
            for f in range(x.shape[1]):
                if not len(cuts[f]):
                    continue
                at = local * width + binned[:, f]
                gs = np.bincount(at, g, count * width).reshape(count, width)
                hs = np.bincount(at, h, count * width).reshape(count, width)
                gl, hl = gs.cumsum(1)[:, : len(cuts[f])], hs.cumsum(1)[:, : len(cuts[f])]
                gt, ht = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                won = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                won[(hl < least) | (ht - hl < least)] = 0
                best = won.argmax(1)
                top = won[np.arange(count), best]
                better = top > gain + 1e-9
                gain[better], cut[better] = top[better], best[better]
                feature[first : first + count][better] = f
            for i in np.flatnonzero(cut >= 0):
                threshold[first + i] = cuts[feature[first + i]][cut[i]]
            node = 2 * node + 2 - (x[np.arange(len(y)), feature[node]] <= threshold[node])
        first = 2**depth - 1
        gs, hs = (np.bincount(node - first, w, 2**depth) for w in (g, h))
        value[first:] = rate * gs / (hs + ridge)
        margin += value[node]
        kept.append((feature, threshold, value))
    forest.feature, forest.threshold, forest.value = (np.stack(a) for a in zip(*kept))
    return forest
