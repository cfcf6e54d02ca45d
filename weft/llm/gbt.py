"""Histogram gradient-boosted trees in numpy: fitted on binned columns, kept as flat arrays, walked for all rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth. Node i's children are 2 i + 1 and 2 i + 2; larger values go right."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes; infinite where a node isn't split
    leaf: np.ndarray  # trees x leaves
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Sums of the leaves that each row reaches; all trees go down a level at a time."""
        out = np.full(len(x), self.base)
        inner = self.cut.shape[1]
        trees = np.arange(len(self.leaf))
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            rows = np.arange(len(part))[:, None]
            at = np.zeros((len(part), len(trees)), np.int64)
            while len(part) and at[0, 0] < inner:
                at = 2 * at + 1 + (part[rows, self.feature[trees, at]] > self.cut[trees, at])
            out[a : a + 4096] += self.leaf[trees, at - inner].sum(1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def cuts_of(column: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between quantiles of a column."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
        return values
    return (values[1:] + values[:-1]) / 2


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, bins: int = 48, rate: float = 0.15, l2: float = 1.0, least: float = 0.5) -> Trees:
    """Logistic loss, second-order gains. y holds 0 and 1; least is the smallest sum of second derivatives in a child.

    With one class only, or without rows, the trees are empty and every score is the smoothed share of ones.
    """
    n, f = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), base)
    if n == 0 or y.min() == y.max():
        return model
    cuts = [cuts_of(x[:, j], bins) for j in range(f)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    width = max(len(c) for c in cuts) + 1
    offset = np.arange(f) * width
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            key = ((at - first) * (f * width))[:, None] + offset + binned
            size = nodes * f * width
            sums = [np.bincount(key.ravel(), np.repeat(w, f), size).reshape(nodes, f, width) for w in (g, h)]
            left_g, left_h = (np.cumsum(s, 2) for s in sums)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
            gain[(left_h < least) | (right_h < least)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            for k in range(nodes):
                j, b = divmod(int(best[k]), width)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    model.feature[t, first + k], model.cut[t, first + k] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), model.feature[t, at]] > model.cut[t, at])
        leaf = at - inner
        sg, sh = (np.bincount(leaf, w, leaves) for w in (g, h))
        model.leaf[t] = rate * sg / (sh + l2)
        raw += model.leaf[t, leaf]
    return model
