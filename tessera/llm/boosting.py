"""Histogram gradient-boosted trees for two classes: fitted on a bounded sample in numpy, flattened
into arrays, and applied to whole batches by vectorised traversal inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete trees, level by level: node i has children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray   # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes): larger values go right
    value: np.ndarray     # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if len(x) == 0:
            return out
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while at[0] < inner:  # all rows are on one level
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
        bins: int = 64, l2: float = 1.0, least: float = 2.0) -> Trees:
    """Boosting by Newton steps on the logistic loss; splits are searched on ``bins`` quantile bins.
    Without rows or with one class the model is a constant."""
    n, width = len(x), x.shape[1]
    inner, leaves = (1 << depth) - 1, 1 << depth
    mean = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(mean / (1 - mean)))
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    margin, fs, ts, vs = np.full(n, base), [], [], []
    for _ in range(trees):
        p = sigmoid(margin)
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            place = (at - first) * bins
            best = np.full(nodes, 1e-6)
            for j in range(width):
                if not len(cuts[j]):
                    continue
                cell = place + binned[j]
                hg = np.cumsum(np.bincount(cell, g, nodes * bins).reshape(nodes, bins), axis=1)
                hh = np.cumsum(np.bincount(cell, h, nodes * bins).reshape(nodes, bins), axis=1)
                sg, sh = hg[:, -1:], hh[:, -1:]
                gain = hg ** 2 / (hh + l2) + (sg - hg) ** 2 / (sh - hh + l2) - sg ** 2 / (sh + l2)
                gain[(hh < least) | (sh - hh < least)] = -1
                gain[:, len(cuts[j]):] = -1
                k = gain.argmax(axis=1)
                top = gain[np.arange(nodes), k]
                for i in np.flatnonzero(top > best):
                    best[i], feature[first + i], threshold[first + i] = top[i], j, cuts[j][k[i]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        margin += value[leaf]
        fs.append(feature), ts.append(threshold), vs.append(value)
    return Trees(base, np.array(fs), np.array(ts), np.array(vs))
