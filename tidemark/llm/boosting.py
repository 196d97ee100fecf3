"""Gradient-boosted trees for the logistic loss over dense features, with isotonic calibration.

Used on a bounded training sample; the fitted model is a few kilobytes of arrays that scoring tasks carry.
"""

from __future__ import annotations

import numpy as np


def _bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    qs = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], qs)) for j in range(x.shape[1])]


def _digitize(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int32)


def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int, depth: int, lam: float, least: float):
    """One tree as level-order arrays (feature, bin threshold, leaf value); a row goes right when its bin exceeds the threshold."""
    size = 2 ** (depth + 1) - 1
    feat, thr, val = np.full(size, -1), np.zeros(size, int), np.zeros(size)
    rows = {0: np.arange(len(g))}
    for node in range(size):
        idx = rows.pop(node, None)
        if idx is None or not len(idx):
            continue
        gs, hs = g[idx].sum(), h[idx].sum()
        val[node] = -gs / (hs + lam)
        if node >= 2**depth - 1 or hs < 2 * least:
            continue
        best, at = 1e-6, None
        for j in range(b.shape[1]):
            col = b[idx, j]
            gl = np.cumsum(np.bincount(col, g[idx], bins))[:-1]
            hl = np.cumsum(np.bincount(col, h[idx], bins))[:-1]
            gain = gl**2 / (hl + lam) + (gs - gl) ** 2 / (hs - hl + lam) - gs**2 / (hs + lam)
            gain[(hl < least) | (hs - hl < least)] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = gain[k], (j, k)
        if at is None:
            continue
        feat[node], thr[node] = at
        right = b[idx, at[0]] > at[1]
        rows[2 * node + 1], rows[2 * node + 2] = idx[~right], idx[right]
    return feat, thr, val


def _tree_value(b: np.ndarray, tree) -> np.ndarray:
    feat, thr, val = tree
    at = np.zeros(len(b), int)
    live = feat[at] >= 0
    while live.any():
        i = np.flatnonzero(live)
        f = feat[at[i]]
        at[i] = 2 * at[i] + 1 + (b[i, f] > thr[at[i]])
        live = feat[at] >= 0
    return val[at]


class BoostedTrees:
    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, lam: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.lam, self.least = trees, depth, rate, bins, lam, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = _bin_edges(x, self.bins)
        b = _digitize(x, self.edges)
        p = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 0.5
        self.base, self.model = float(np.log(p / (1 - p))), []
        f = np.full(len(y), self.base)
        for _ in range(self.trees if 0 < y.sum() < len(y) else 0):
            q = 1 / (1 + np.exp(-f))
            tree = _grow(b, q - y, np.maximum(q * (1 - q), 1e-6), self.bins + 1, self.depth, self.lam, self.least)
            self.model.append(tree)
            f += self.rate * _tree_value(b, tree)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = _digitize(x, self.edges)
        f = np.full(len(x), self.base)
        for tree in self.model:
            f += self.rate * _tree_value(b, tree)
        return f


class Isotonic:
    """Pool-adjacent-violators fit of P(y = 1 | raw score), linear between block centres and clipped outside."""

    def fit(self, raw: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(raw, kind="stable")
        blocks: list[list[float]] = []  # weight, sum of y, sum of raw
        for r, t in zip(raw[order], y[order], strict=True):
            blocks.append([1.0, float(t), float(r)])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                w, s, c = blocks.pop()
                blocks[-1][0] += w
                blocks[-1][1] += s
                blocks[-1][2] += c
        a = np.array(blocks).reshape(-1, 3)
        self.x = a[:, 2] / a[:, 0] if len(a) else np.zeros(1)
        # one pseudo-count per class keeps end blocks off exactly 0 and 1
        self.y = (a[:, 1] + 0.02) / (a[:, 0] + 0.04) if len(a) else np.full(1, 0.5)
        self.y = np.maximum.accumulate(self.y)
        return self

    def apply(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.x, self.y), 0.0, 1.0)
