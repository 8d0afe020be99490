"""Gradient-boosted trees for a 0/1 label over a few dense features, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 64


@dataclass
class Trees:
    """Complete binary trees of one depth. ``features`` and ``cuts`` have a row for each tree with a place for each
    inner node in the order of levels; a row goes right where its feature is above the cut."""

    base: float
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(len(leaves).bit_length() - 1):
                node = 2 * node + 1 + (x[row, features[node]] > cuts[node])
            out += leaves[node - len(features)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, penalty: float = 1.0, least: float = 1.0) -> Trees:
    """Newton boosting of the log loss. Splits are looked for between quantiles of each feature, a level at a time,
    from histograms of the gradients. Without rows, or with one label only, the base rate is all there is."""
    mean = (y.sum() + 0.5) / (len(y) + 1)
    trees = Trees(float(np.log(mean / (1 - mean))))
    if not len(y) or y.min() == y.max():
        return trees
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], 1)
    margin = np.full(n, trees.base)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        features, cuts, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, BINS)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            best = np.full(wide, 1e-6)
            for k in range(d):
                key = (node - first) * BINS + binned[:, k]
                gs = np.bincount(key, g, wide * BINS).reshape(wide, BINS).cumsum(1)
                hs = np.bincount(key, h, wide * BINS).reshape(wide, BINS).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
                gain[(hs < least) | (ht - hs < least)] = 0
                gain[:, len(edges[k]) :] = 0
                top = gain.argmax(1)
                better = np.flatnonzero(gain[np.arange(wide), top] > best)
                best[better] = gain[better, top[better]]
                features[first + better], at[first + better] = k, top[better]
                cuts[first + better] = edges[k][top[better]]
            node = 2 * node + 1 + (binned[np.arange(n), features[node]] > at[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + penalty)
        margin += value[leaf]
        trees.features.append(features)
        trees.cuts.append(cuts)
        trees.leaves.append(value)
    return trees


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, probabilities), both ascending: the best non-decreasing fit, by pooling neighbours that go down.
    Between two of the scores, probabilities are read from a straight line. Each end is drawn in by half a row, so that
    no probability is quite 0 or 1."""
    values, at = np.unique(score, return_inverse=True)
    pools: list[list[float]] = []  # weight, labels, first and last score
    for v, w, s in zip(values.tolist(), np.bincount(at).tolist(), np.bincount(at, y).tolist()):
        pools.append([w, s, v, v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w2, s2, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + w2, pools[-1][1] + s2, pools[-1][2], last]
    xs, ys = [], []
    for w, s, first, last in pools:
        p = min(max(s / w, 0.5 / (w + 1)), (w + 0.5) / (w + 1))
        for v in dict.fromkeys((first, last)):
            xs.append(v)
            ys.append(p)
    return np.array(xs), np.maximum.accumulate(np.array(ys))
