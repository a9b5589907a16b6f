"""Gradient-boosted trees for two classes, with binned features."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic boosting of trees of a fixed depth.  A tree is stored as full
    levels of (feature, threshold) and its leaves' values."""

    def __init__(self, trees: int = 100, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0, least: float = 5.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least
        self.start, self.features, self.cuts, self.leaves = 0.0, [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        share = np.linspace(0, 1, self.bins + 1)[1:-1]
        edges = [np.unique(np.quantile(column, share)) for column in x.T]
        binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)]).astype(np.int64)
        mean = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4)
        self.start = float(np.log(mean / (1 - mean)))
        score = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (p - y), weight * p * (1 - p)
            node = np.zeros(len(y), np.int64)
            features, cuts = [], []
            for level in range(self.depth):
                nodes = 1 << level
                best = np.full(nodes, 0.0)
                feature, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
                place = np.full(nodes, self.bins)
                for f, column in enumerate(binned):
                    if not len(edges[f]):
                        continue
                    cell = node * self.bins + column
                    gs = np.bincount(cell, g, nodes * self.bins).reshape(nodes, -1).cumsum(1)
                    hs = np.bincount(cell, h, nodes * self.bins).reshape(nodes, -1).cumsum(1)
                    ga, ha = gs[:, -1:], hs[:, -1:]
                    gain = gs ** 2 / (hs + self.ridge) + (ga - gs) ** 2 / (ha - hs + self.ridge) - ga ** 2 / (ha + self.ridge)
                    gain[(hs < self.least * 0.05) | (ha - hs < self.least * 0.05)] = 0
                    at = gain[:, :len(edges[f])].argmax(1)
                    found = gain[np.arange(nodes), at]
                    better = found > best + 1e-9
                    best[better], feature[better], place[better] = found[better], f, at[better]
                    cut[better] = edges[f][at[better]]
                node = node * 2 + (binned[feature[node], np.arange(len(y))] > place[node])
                features.append(feature)
                cuts.append(cut)
            gs, hs = np.bincount(node, g, 1 << self.depth), np.bincount(node, h, 1 << self.depth)
            leaf = -self.rate * gs / (hs + self.ridge)
            score += leaf[node]
            self.features.append(features)
            self.cuts.append(cuts)
            self.leaves.append(leaf)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the rows."""
        score, rows = np.full(len(x), self.start), np.arange(len(x))
        for features, cuts, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for feature, cut in zip(features, cuts, strict=True):
                node = node * 2 + (x[rows, feature[node]] > cut[node])
            score += leaf[node]
        return score
