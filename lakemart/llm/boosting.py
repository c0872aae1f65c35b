"""Gradient-boosted trees for two classes, in numpy: small, fitted on bounded samples."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, depth-wise trees over binned features, Newton leaf values; each tree
    sees a share of the features."""

    def __init__(self, trees: int = 120, depth: int = 5, rate: float = 0.15, bins: int = 32, least: float = 8.0, share: float = 0.4):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.share = share
        self.start = 0.0
        self.cuts: list[np.ndarray] = []
        #: per tree: feature and cut of each inner node (in heap order), value of each leaf
        self.features: list[np.ndarray] = []
        self.limits: list[np.ndarray] = []
        self.values: list[np.ndarray] = []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        shares = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(column, shares, method="lower")) for column in x.T]
        binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(self.cuts, x.T, strict=True)])
        rate = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.start)
        rng = np.random.default_rng(len(y))
        for _ in range(self.trees):
            drawn = rng.permutation(len(binned))[: max(1, int(self.share * len(binned)))]
            p = 1 / (1 + np.exp(-score))
            self._grow(binned, drawn, weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6))
            score += self._leaves(x, -1)
        return self

    def _grow(self, binned: np.ndarray, drawn: np.ndarray, slope: np.ndarray, bend: np.ndarray) -> None:
        inner = (1 << self.depth) - 1
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(binned.shape[1], dtype=np.int64)
        for level in range(self.depth):
            base, size = (1 << level) - 1, 1 << level
            best = np.full(size, 1e-9)
            split = np.full(size, -1)
            for f in drawn.tolist():
                b = binned[f]
                width = len(self.cuts[f]) + 1
                if width < 2:
                    continue
                place = node * width + b
                g = np.bincount(place, weights=slope, minlength=size * width).reshape(size, width)
                h = np.bincount(place, weights=bend, minlength=size * width).reshape(size, width)
                gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
                gt, ht = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < self.least / 8) | (ht - hl < self.least / 8)] = 0
                at = gain.argmax(axis=1)
                found = gain[np.arange(size), at]
                better = found > best
                best[better] = found[better]
                split[better] = f
                feature[base : base + size][better] = f
                limit[base : base + size][better] = self.cuts[f][at[better]]
            go = np.zeros(len(node), dtype=bool)
            for k in np.flatnonzero(split >= 0).tolist():
                cut = int(np.searchsorted(self.cuts[split[k]], limit[base + k], "left"))
                go |= (node == k) & (binned[split[k]] > cut)
            node = node * 2 + go
        leaves = 1 << self.depth
        g = np.bincount(node, weights=slope, minlength=leaves)
        h = np.bincount(node, weights=bend, minlength=leaves)
        self.features.append(feature)
        self.limits.append(limit)
        self.values.append(self.rate * g / (h + 1))

    def _leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        feature, limit, at = self.features[tree], self.limits[tree], np.zeros(len(x), dtype=np.int64)
        number = np.arange(len(x))
        for _ in range(self.depth):
            at = at * 2 + 1 + (x[number, feature[at]] > limit[at])
        return self.values[tree][at - (len(limit))]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in range(len(self.values)):
            out += self._leaves(x, tree)
        return out
