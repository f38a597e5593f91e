"""Histogram gradient-boosted trees in numpy, flattened for vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete binary trees of one depth as arrays: node k has the children 2k+1 and 2k+2."""

    feature: np.ndarray  # (trees, 2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2^depth)
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The summed leaves of each row: all trees descend together, a level at a time."""
        n, trees = len(x), len(self.leaf)
        out = np.full(n, self.base)
        for at in range(0, n, 4096):
            part = x[at : at + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), trees), np.int64)
            tree = np.arange(trees)[None, :]
            for _ in range(self.depth):
                node = 2 * node + 1 + (part[rows, self.feature[tree, node]] > self.threshold[tree, node])
            out[at : at + 4096] += self.leaf[tree, node - (2**self.depth - 1)].sum(1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 2.0, least: int = 12) -> Forest:
    """Logistic loss; histograms of gradients and hessians by node, feature and bin."""
    n, width = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0:
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0, depth)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1).astype(np.int64)
    rate_1 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_1 / (1 - rate_1)))
    margin = np.full(n, base)
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    flat = code + np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            wide = 2**level
            size = wide * width * bins
            at = ((node - (wide - 1))[:, None] * (width * bins) + flat).ravel()
            hist = [np.bincount(at, np.repeat(v, width), size).reshape(wide, width, bins) for v in (g, h)]
            count = np.bincount(at, minlength=size).reshape(wide, width, bins)
            gl, hl, nl = (np.cumsum(v, 2) for v in (*hist, count))
            gt, ht, nt = gl[:, :1, -1:], hl[:, :1, -1:], nl[:, :1, -1:]
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(nl < least) | (nt - nl < least)] = -1
            best = gain.reshape(wide, -1).argmax(1)
            for k in range(wide):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    feature[t, wide - 1 + k], threshold[t, wide - 1 + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        slot = node - inner
        gs, hs = np.bincount(slot, g, leaves), np.bincount(slot, h, leaves)
        leaf[t] = -rate * gs / (hs + l2)
        margin += leaf[t, slot]
    return Forest(feature, threshold, leaf, base, depth)
