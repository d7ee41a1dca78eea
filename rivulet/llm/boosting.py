"""Gradient-boosted trees for two classes, in numpy: logistic loss, features in quantile bins, Newton steps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class BoostedTrees:
    borders: list[np.ndarray]
    start: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature, bin per inner node; value per leaf

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, x[:, k], side="left") for k, b in enumerate(self.borders)], axis=1).astype(np.uint8)

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned, score = self._binned(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(value)))):
                at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
            score += value[at - len(feature)]
        return 1 / (1 + np.exp(-score))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, least: float = 5.0, ridge: float = 1.0) -> BoostedTrees:
    """``y`` in 0..1; a split needs ``least`` rows' worth of curvature on both sides."""
    borders = [np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS)) for k in range(x.shape[1])]
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = BoostedTrees(borders, float(np.log(share / (1 - share))), [])
    binned, score = model._binned(x), np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        model.trees.append(_tree(binned, y - p, p * (1 - p), depth, rate, least / 4, ridge))
        feature, cut, value = model.trees[-1]
        at = np.zeros(len(x), np.int64)
        for _ in range(depth):
            at = 2 * at + 1 + (binned[np.arange(len(x)), feature[at]] > cut[at])
        score += value[at - len(feature)]
    return model


def _tree(binned, gradient, curve, depth, rate, least, ridge):
    inner = (1 << depth) - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
    at = np.zeros(len(binned), np.int64)
    for level in range(depth):
        first, n = (1 << level) - 1, 1 << level
        here = at - first
        best = np.zeros(n)
        total_g, total_h = np.bincount(here, gradient, n), np.bincount(here, curve, n)
        for k in range(binned.shape[1]):
            cell = here * BINS + binned[:, k]
            g = np.bincount(cell, gradient, n * BINS).reshape(n, BINS).cumsum(axis=1)
            h = np.bincount(cell, curve, n * BINS).reshape(n, BINS).cumsum(axis=1)
            right_g, right_h = total_g[:, None] - g, total_h[:, None] - h
            gain = g * g / (h + ridge) + right_g * right_g / (right_h + ridge) - (total_g * total_g / (total_h + ridge))[:, None]
            gain[(h < least) | (right_h < least)] = 0
            where = gain.argmax(axis=1)
            better = gain[np.arange(n), where] > best + 1e-12
            best = np.where(better, gain[np.arange(n), where], best)
            feature[first : first + n][better] = k
            cut[first : first + n][better] = where[better]
        at = 2 * at + 1 + (binned[np.arange(len(binned)), feature[at]] > cut[at])
    leaf = at - inner
    return feature, cut, rate * np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, curve, inner + 1) + ridge)
