"""Small gradient-boosted trees for binary labels (logistic loss), with numpy."""

from __future__ import annotations

import numpy as np


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: int, cuts: list[np.ndarray]) -> tuple:
    """Nested (feature, cut, left, right) or a leaf value: x <= cut goes left."""
    value = float(-g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(x) < 2 * least:
        return (value,)
    best, total = None, g.sum() ** 2 / (h.sum() + 1.0)
    for f, edges in enumerate(cuts):
        if not len(edges):
            continue
        at = np.searchsorted(edges, x[:, f], side="left")
        gs, hs, ns = (np.cumsum(np.bincount(at, w, len(edges) + 1))[:-1] for w in (g, h, np.ones(len(g))))
        gain = gs ** 2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - total
        gain[(ns < least) | (len(x) - ns < least)] = -1
        k = int(gain.argmax())
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (gain[k], f, edges[k])
    if best is None:
        return (value,)
    left = x[:, best[1]] <= best[2]
    return (best[1], float(best[2]), _tree(x[left], g[left], h[left], depth - 1, least, cuts),
            _tree(x[~left], g[~left], h[~left], depth - 1, least, cuts))


def _value(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    left = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[left], out[~left] = _value(tree[2], x[left]), _value(tree[3], x[~left])
    return out


class BoostedTrees:
    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, least: int = 5, bins: int = 32):
        self.rounds, self.depth, self.rate, self.least, self.bins = rounds, depth, rate, least, bins
        self.start, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)))[:-1] for f in range(x.shape[1])]
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = _tree(x, p - y, p * (1 - p), self.depth, self.least, cuts)
            self.trees.append(tree)
            score += self.rate * _value(tree, x)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += self.rate * _value(tree, x)
        return 1 / (1 + np.exp(-score))


def calibrated_threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least score from which on the share of positives among greater scores is at least ``precision``."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.r_[score[order][1:] != score[order][:-1], True]  # equal scores stand together
    good = np.flatnonzero((share >= precision) & last)
    return float(score[order][good[-1]]) if len(good) else float("inf")
