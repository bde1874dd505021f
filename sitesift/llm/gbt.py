"""Gradient-boosted trees for two classes: logistic loss, Newton steps, histogram splits, trees of fixed depth.

Trees are complete: a node that is not worth a split sends all rows left, so a
model is three arrays and scoring is a few gathers a level for all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); rows with a value <= it go left
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node[0] < len(feature) if len(node) else False:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - len(feature)] if len(node) else 0
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 45, depth: int = 4, rate: float = 0.25, bins: int = 32,
        least: float = 5.0, penalty: float = 1.0) -> Boosted:
    """``y`` in 0, 1. ``least``: hessian weight that a side of a split needs."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)  # v <= cuts[b] for bin <= b
    n, f = binned.shape
    flat = binned + np.arange(f) * bins
    p0 = np.average(y, weights=weight)
    base = float(np.log(p0 / (1 - p0)))
    score = np.full(n, base)
    inner = (1 << depth) - 1
    model = Boosted(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, inner + 1)), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = (p - y) * weight, p * (1 - p) * weight
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            key = (node - first)[:, None] * (f * bins) + flat
            hist = [np.bincount(key.ravel(), np.repeat(v, f), many * f * bins).reshape(many, f, bins).cumsum(axis=2) for v in (g, h)]
            gl, hl = hist
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt ** 2 / (ht + penalty)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                feature, cut = divmod(int(best[k]), bins)
                if gain[k, feature, cut] > 1e-6 and cut < len(cuts[feature]):
                    model.feature[t, first + k], model.threshold[t, first + k] = feature, cuts[feature][cut]
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.threshold[t, node])
        at = node - inner
        gs, hs = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
        model.leaf[t] = -rate * gs / (hs + penalty)
        score += model.leaf[t][at]
    return model
