"""Gradient-boosted regression trees for a yes-no question, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Boosted:
    """Complete trees of one depth: inner nodes in breadth-first order, then leaves."""

    edges: list[np.ndarray]
    feature: np.ndarray  # tree x inner node
    below: np.ndarray  # goes left if the bin is at most this
    leaf: np.ndarray  # tree x leaf
    base: float

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        bins, out, rows = self._bins(x), np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, below, leaf in zip(self.feature, self.below, self.leaf):
            node = np.zeros(len(x), np.int64)
            while node[0] < inner:
                node = 2 * node + 1 + (bins[rows, feature[node]] > below[node])
            out += leaf[node - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, ridge: float = 2.0) -> Boosted:
    """Newton steps on the logistic loss, trees grown level by level over histograms."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    model = Boosted(edges, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros((0, 0)), 0.0)
    bins = model._bins(x)
    share = np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(share / (1 - share)))
    f = np.full(len(y), model.base)
    inner, features, belows, leaves = 2**depth - 1, [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = (y - p) * weight, p * (1 - p) * weight
        feature, below = np.zeros(inner, np.int64), np.full(inner, 255, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            at = node - first
            best = np.full(n, 1e-6)
            for j in range(x.shape[1]):
                cell = at * (BINS + 1) + bins[:, j]
                gs = np.bincount(cell, g, n * (BINS + 1)).reshape(n, -1)
                hs = np.bincount(cell, h, n * (BINS + 1)).reshape(n, -1)
                gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                gt, ht = gs.sum(1)[:, None], hs.sum(1)[:, None]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                cut = gain.argmax(1)
                value = gain[np.arange(n), cut]
                better = value > best
                best[better] = value[better]
                feature[first : first + n][better] = j
                below[first : first + n][better] = cut[better]
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > below[node])
        at = node - inner
        leaf = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        f += leaf[at]
        features.append(feature)
        belows.append(below)
        leaves.append(leaf)
    model.feature, model.below, model.leaf = np.array(features), np.array(belows), np.array(leaves)
    return model
