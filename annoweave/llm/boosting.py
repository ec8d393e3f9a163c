"""Gradient-boosted trees on a small table, with Platt calibration."""

from __future__ import annotations

import numpy as np

BINS = 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BoostedTrees:
    """Binary classifier: depth-limited histogram trees on the logistic loss."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, least: int = 8, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.least, self.ridge = trees, depth, rate, least, ridge
        self.slope, self.shift = 1.0, 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, f = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
        b = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)
        flat = b + np.arange(f) * BINS
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        raw = np.full(n, self.base)
        self.model = []
        for _ in range(self.trees):
            p = _sigmoid(raw)
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, dtype=np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, BINS, np.int64)
            for level in range(self.depth):
                first, many = 2**level - 1, 2**level
                at = ((node - first)[:, None] * (f * BINS) + flat).ravel()
                size = many * f * BINS
                sums = [np.bincount(at, np.repeat(w, f), size).reshape(many, f, BINS).cumsum(2) for w in (g, h, np.ones(n))]
                lg, lh, ln = sums
                tg, th, tn = (s[:, :, -1:] for s in sums)
                gain = lg**2 / (lh + self.ridge) + (tg - lg) ** 2 / (th - lh + self.ridge) - tg**2 / (th + self.ridge)
                gain[(ln < self.least) | (tn - ln < self.least)] = -1
                best = gain.reshape(many, -1).argmax(1)
                ok = gain.reshape(many, -1).max(1) > 1e-6
                feature[first : first + many] = np.where(ok, best // BINS, 0)
                cut[first : first + many] = np.where(ok, best % BINS, BINS)
                node = 2 * node + 1 + (b[np.arange(n), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.ridge)
            raw += value[leaf]
            self.model.append((feature, cut, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.model:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            raw += value[node - (2**self.depth - 1)]
        return raw

    def calibrate(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> BoostedTrees:
        """Platt scaling by Newton steps, drawn to slope 1 and shift 0 where the holdout says little."""
        m = np.clip(self.margin(x), -6, 6)
        w = np.array([1.0, 0.0])
        d = np.stack([m, np.ones(len(m))], 1)
        for _ in range(30):
            p = _sigmoid(d @ w)
            grad = d.T @ (y - p) - ridge * (w - [1.0, 0.0])
            w = w + np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(2), grad)
        self.slope, self.shift = float(max(w[0], 0.05)), float(w[1])
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.shift)


class Averaged(BoostedTrees):
    """Several models whose margins are averaged, calibrated as one."""

    def __init__(self, many: int, trees: int):
        super().__init__(trees)
        self.models = [BoostedTrees(trees=trees) for _ in range(many)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.mean([m.margin(x) for m in self.models], axis=0)
