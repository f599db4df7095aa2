"""Gradient-boosted trees for yes-or-no labels, on histograms, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Additive trees of the log-odds. Each tree is arrays (feature, threshold, left, right, value); feature -1 is a leaf."""

    rounds: int = 60
    depth: int = 4
    rate: float = 0.25
    bins: int = 32
    smooth: float = 1.0
    base: float = 0.0
    trees: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base, self.trees = float(np.log(share / (1 - share))), []
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, edges, p - y, p * (1 - p))
            self.trees.append(tree)
            score += self._one(tree, x)
        return self

    def _grow(self, binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        feature, threshold, left, right, value = [], [], [], [], []

        def add(rows: np.ndarray, depth: int) -> int:
            me = len(feature)
            for column, empty in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1)):
                column.append(empty)
            gs, hs = g[rows].sum(), h[rows].sum()
            value.append(-self.rate * gs / (hs + self.smooth))
            if depth == 0 or len(rows) < 4:
                return me
            best, cut = 1e-6, None
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, j]
                gl = np.cumsum(np.bincount(b, g[rows], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(e) + 1))[:-1]
                gain = gl**2 / (hl + self.smooth) + (gs - gl) ** 2 / (hs - hl + self.smooth) - gs**2 / (hs + self.smooth)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, cut = gain[k], (j, k)
            if cut is None:
                return me
            j, k = cut
            low = binned[rows, j] <= k
            if low.all() or not low.any():
                return me
            feature[me], threshold[me] = j, float(edges[j][k])
            left[me] = add(rows[low], depth - 1)
            right[me] = add(rows[~low], depth - 1)
            return me

        add(np.arange(len(g)), self.depth)
        return tuple(np.array(c) for c in (feature, threshold, left, right, value))

    def _one(self, tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
        feature, threshold, left, right, value = tree
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = feature[at]
            go = f >= 0
            if not go.any():
                break
            low = x[rows, np.maximum(f, 0)] <= threshold[at]
            at = np.where(go, np.where(low, left[at], right[at]), at)
        return value[at]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += self._one(tree, x)
        return out
