"""Gradient-boosted regression trees for two classes, on a few thousand rows of numpy features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A full binary tree by level: node i has children 2 i + 1 and 2 i + 2; a node that was not split sends all rows left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.cut[at])
        return self.value[at - (2**self.depth - 1)]


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t(x)
        return out


def _split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int, ridge: float) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split of some rows: rows of a bin up to it go left."""
    best = (0.0, 0, bins)
    whole = g.sum() ** 2 / (h.sum() + ridge)
    for f in range(binned.shape[1]):
        gl = np.cumsum(np.bincount(binned[:, f], g, bins))[:-1]
        hl = np.cumsum(np.bincount(binned[:, f], h, bins))[:-1]
        gain = gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - whole
        gain[(hl < 1e-3) | (h.sum() - hl < 1e-3)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0] + 1e-9:
            best = (float(gain[k]), f, k)
    return best


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Second-order boosting of the logistic loss over quantile bins."""
    weight = np.ones(len(y)) if weight is None else weight
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    share = np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), [])
    logit = np.full(len(y), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logit))
        g, h = (y - p) * weight, p * (1 - p) * weight
        inner = 2**depth - 1
        tree = Tree(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**depth), depth)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            if len(rows) > 1:
                gain, f, k = _split(binned[rows], g[rows], h[rows], bins, ridge)
                if gain > 0 and k < len(cuts[f]):
                    tree.feature[node], tree.cut[node] = f, cuts[f][k]
            at[rows] = 2 * node + 1 + (x[rows, tree.feature[node]] > tree.cut[node])
        leaf = at - inner
        tree.value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        logit += tree(x)
        model.trees.append(tree)
    return model
