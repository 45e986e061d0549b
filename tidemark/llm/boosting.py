"""Histogram gradient-boosted trees in numpy: trained in one task on a bounded sample, flattened into arrays, applied to batches.

A tree of depth d is a complete binary tree in level order: 2**d - 1 inner nodes (feature, threshold) and 2**d leaves (value). A node that
isn't split sends every row to the left. All trees go through a batch at once, one step per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    base: float
    feature: np.ndarray  # trees x inner nodes, int
    threshold: np.ndarray  # trees x inner nodes; a value above goes right
    leaf: np.ndarray  # trees x leaves

    def chance(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        n, (trees, inner) = len(x), self.feature.shape
        depth = (inner + 1).bit_length() - 1
        at = np.zeros((n, trees), np.int64)
        own, row = np.arange(trees)[None, :], np.arange(n)[:, None]
        for _ in range(depth):
            at = 2 * at + 1 + (x[row, self.feature[own, at]] > self.threshold[own, at])
        return 1 / (1 + np.exp(-(self.base + self.leaf[own, at - inner].sum(axis=1))))

    def pack(self) -> dict:
        return {"base": self.base, "feature": self.feature.tolist(), "threshold": self.threshold.tolist(), "leaf": self.leaf.tolist()}

    @classmethod
    def unpack(cls, d) -> Trees:
        if not len(d["feature"]):
            return cls(float(d["base"]), np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)))
        return cls(float(d["base"]), np.array(d["feature"], np.int64), np.array(d["threshold"], float), np.array(d["leaf"], float))


def train(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Trees for the log loss of labels 0 and 1. One kind of label, or no rows, gives no trees and the smoothed share of label 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    inner, n_features = 2**depth - 1, x.shape[1]
    if not 0 < y.sum() < len(y):
        trees = 0
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(n_features)]
    place = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)  # bin b: cut[b - 1] < value <= cut[b]
    cell = place + np.arange(n_features) * bins
    total, rows = np.full(len(y), base), np.arange(len(y))
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, curve = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            flat = ((at - first)[:, None] * (n_features * bins) + cell).ravel()
            shape = (nodes, n_features, bins)
            g = np.bincount(flat, np.repeat(grad, n_features), nodes * n_features * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(flat, np.repeat(curve, n_features), nodes * n_features * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least)] = 0
            for f, c in enumerate(cuts):
                gain[:, f, len(c) :] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k, b in enumerate(best):
                f, cut = divmod(int(b), bins)
                if gain[k, f, cut] > 1e-6:
                    out.feature[t, first + k], out.threshold[t, first + k] = f, cuts[f][cut]
            at = 2 * at + 1 + (x[rows, out.feature[t, at]] > out.threshold[t, at])
        g = np.bincount(at - inner, grad, inner + 1)
        h = np.bincount(at - inner, curve, inner + 1)
        out.leaf[t] = rate * g / (h + ridge)
        total += out.leaf[t][at - inner]
    return out
