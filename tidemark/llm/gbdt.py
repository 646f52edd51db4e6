"""Gradient-boosted trees for two classes, by histograms, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: split feature and value of each inner node, value of each leaf."""

    base: float
    depth: int
    feature: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, value, leaf in zip(self.feature, self.value, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > value[node])
            out += leaf[node - (2 ** self.depth - 1)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.25,
        bins: int = 32, l2: float = 1.0) -> Trees:
    """Boosted trees for labels 0/1; without labels of both kinds, the constant."""
    mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = Trees(float(np.log(mean / (1 - mean))), depth)
    if not len(y) or y.min() == y.max():
        return model
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    logit = np.full(n, model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logit))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature = np.zeros(2 ** depth - 1, np.int64)
        value = np.full(2 ** depth - 1, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = node - first
            best = np.full(width, 1e-6)
            pick = np.zeros((width, 2), np.int64) - 1
            for j in range(d):
                key = at * (bins + 1) + binned[:, j]
                g = np.bincount(key, grad, width * (bins + 1)).reshape(width, -1).cumsum(1)
                h = np.bincount(key, hess, width * (bins + 1)).reshape(width, -1).cumsum(1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g * g / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt * gt / (ht + l2)
                gain = gain[:, :len(edges[j])]
                if gain.shape[1]:
                    b = gain.argmax(1)
                    top = gain[np.arange(width), b]
                    better = top > best
                    best[better] = top[better]
                    pick[better] = np.stack([np.full(width, j), b], 1)[better]
            for w in np.flatnonzero(pick[:, 0] >= 0):
                feature[first + w], value[first + w] = pick[w, 0], edges[pick[w, 0]][pick[w, 1]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > value[node])
        leaf_at = node - (2 ** depth - 1)
        g, h = np.bincount(leaf_at, grad, 2 ** depth), np.bincount(leaf_at, hess, 2 ** depth)
        leaf = -rate * g / (h + l2)
        logit += leaf[leaf_at]
        model.feature.append(feature)
        model.value.append(value)
        model.leaf.append(leaf)
    return model
