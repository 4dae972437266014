"""Gradient-boosted trees for a bounded sample of dense features, and isotonic calibration.

The sample is fitted on the driver (its bound is a parameter of the callers);
scoring runs in tasks on batches.
"""

from __future__ import annotations

import numpy as np

BINS = 64


class BoostedTrees:
    """Logistic loss, complete trees of fixed depth over quantile bins."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 5.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        rows, cols = x.shape
        share = (y.sum() + 1.0) / (rows + 2.0)
        self.start = float(np.log(share / (1 - share)))
        self.edges = []
        for c in range(cols):
            values = np.unique(x[:, c])
            cuts = (values[1:] + values[:-1]) / 2
            if len(cuts) > BINS - 1:
                cuts = np.unique(np.quantile(x[:, c], np.arange(1, BINS) / BINS))
            self.edges.append(cuts)
        binned = np.column_stack([np.searchsorted(e, x[:, c], side="left") for c, e in enumerate(self.edges)]) if rows else np.zeros((0, cols), int)
        self.fitted = []
        f = np.full(rows, self.start)
        for _ in range(self.trees if rows else 0):
            p = 1 / (1 + np.exp(-f))
            grad, hess = y - p, p * (1 - p)
            node = np.zeros(rows, int)
            splits = []
            for level in range(self.depth):
                width = 1 << level
                best = [(0.0, 0, -1)] * width
                for c in range(cols):
                    key = node * BINS + binned[:, c]
                    g = np.bincount(key, grad, width * BINS).reshape(width, BINS).cumsum(1)
                    h = np.bincount(key, hess, width * BINS).reshape(width, BINS).cumsum(1)
                    gt, ht = g[:, -1:], h[:, -1:]
                    gain = g ** 2 / (h + self.ridge) + (gt - g) ** 2 / (ht - h + self.ridge) - gt ** 2 / (ht + self.ridge)
                    at = gain.argmax(1)
                    for n in range(width):
                        if gain[n, at[n]] > best[n][0] + 1e-9:
                            best[n] = (gain[n, at[n]], c, at[n])
                # no split found: everything goes left
                feature = np.array([b[1] for b in best])
                cut = np.array([b[2] if b[2] >= 0 else BINS for b in best])
                splits.append((feature, cut))
                node = 2 * node + (binned[np.arange(rows), feature[node]] > cut[node])
            leaves = self.rate * np.bincount(node, grad, 1 << self.depth) / (np.bincount(node, hess, 1 << self.depth) + self.ridge)
            self.fitted.append((splits, leaves))
            f = f + leaves[node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = len(x)
        binned = np.column_stack([np.searchsorted(e, x[:, c], side="left") for c, e in enumerate(self.edges)]) if rows else np.zeros((0, x.shape[1]), int)
        f = np.full(rows, self.start)
        at = np.arange(rows)
        for splits, leaves in self.fitted:
            node = np.zeros(rows, int)
            for feature, cut in splits:
                node = 2 * node + (binned[at, feature[node]] > cut[node])
            f += leaves[node]
        return f


class Isotonic:
    """Pool-adjacent-violators fit of labels on margins, interpolated between pools.

    Each pool's share is shrunk by one pseudo-row towards the overall share, so no score is 0 or 1."""

    def fit(self, margin: np.ndarray, y: np.ndarray) -> "Isotonic":
        overall = (y.sum() + 1.0) / (len(y) + 2.0)
        pools: list[list[float]] = []  # sum, weight, first and last margin
        order = np.argsort(margin, kind="stable")
        for m, v in zip(margin[order], y[order]):
            pools.append([float(v), 1.0, m, m])
            while len(pools) > 1 and (pools[-1][2] == pools[-2][3] or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]):
                s, w, _, last = pools.pop()
                pools[-1][0] += s
                pools[-1][1] += w
                pools[-1][3] = last
        self.x = np.array([v for p in pools for v in ([p[2], p[3]] if p[3] > p[2] else [p[2]])] or [0.0])
        self.y = np.array([(p[0] + overall) / (p[1] + 1) for p in pools for _ in range(2 if p[3] > p[2] else 1)] or [overall])
        self.y = np.maximum.accumulate(self.y)
        return self

    def apply(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.x, self.y)
