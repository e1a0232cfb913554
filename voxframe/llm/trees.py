"""A small classifier of gradient-boosted trees on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosted:
    """Trees of equal depth as arrays: a split of every inner node, a value of every leaf."""

    start: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    bound: np.ndarray  # goes right if above
    value: np.ndarray  # (trees, 2**depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row."""
        out = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, bound, value in zip(self.feature, self.bound, self.value):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += value[at - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 4.0) -> Boosted:
    """Boost trees on log loss; splits are chosen level by level among the bins' edges."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    odds = np.full(len(y), start)
    inner = 2**depth - 1
    all_features, all_bounds, all_values = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-odds))
        slope, weight = y - chance, chance * (1 - chance)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for f in range(x.shape[1]):
                if not len(edges[f]):
                    continue
                cell = (at - first) * bins + binned[:, f]
                g = np.cumsum(np.bincount(cell, slope, width * bins).reshape(width, bins), 1)
                h = np.cumsum(np.bincount(cell, weight, width * bins).reshape(width, bins), 1)
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(h < least / 4) | (h[:, -1:] - h < least / 4)] = 0
                gain = gain[:, : len(edges[f])]
                top = gain.argmax(1)
                better = np.flatnonzero(gain[np.arange(width), top] > best)
                best[better] = gain[better, top[better]]
                feature[first + better], bound[first + better] = f, edges[f][top[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > bound[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, weight, inner + 1) + 1)
        odds += value[leaf]
        all_features.append(feature)
        all_bounds.append(bound)
        all_values.append(value)
    return Boosted(start, np.array(all_features), np.array(all_bounds), np.array(all_values))
