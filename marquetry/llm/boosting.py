"""Gradient-boosted regression trees on binned features, and isotonic calibration. NumPy only; for samples of bounded size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """A fitted ensemble: bin edges of each feature; for each tree the split feature, bin and value of its nodes."""

    edges: list[np.ndarray]
    feature: np.ndarray  # trees x inner nodes; -1 where the node doesn't split
    cut: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = bin_features(x, self.edges)
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                g = f[node]
                right = (g >= 0) & (binned[rows, np.maximum(g, 0)] > c[node])
                node = 2 * node + 1 + right
            out += v[node - (2**self.depth - 1)]
        return out


def bin_features(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], 1).astype(np.int16)


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 150, depth: int = 4, rate: float = 0.08, bins: int = 48, least: int = 8, l2: float = 2.0, share: float = 0.7, seed: int = 0) -> Trees:
    """Least-squares boosting with level-wise histogram trees; each tree sees a share of the rows and features."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = bin_features(x, edges).astype(np.int64)
    n, m = x.shape
    base = float(y.mean())
    score = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    out = Trees(edges, np.full((trees, inner), -1), np.zeros((trees, inner), np.int64), np.zeros((trees, leaves)), base, depth)
    # a cell's count and sum are added up as one number, from which both can be told
    one = 4.0 * (np.abs(y - base).max(initial=0.0) + 1.0) * max(n, 1) * 2
    for t in range(trees):
        pick = np.flatnonzero(rng.random(n) < share)
        columns = np.flatnonzero(rng.random(m) < share)
        if not len(columns):
            columns = np.arange(m)
        left = y - score
        width = len(columns) * bins
        cells = binned[np.ix_(pick, columns)] + np.arange(len(columns)) * bins
        value = left[pick] + one
        node = np.zeros(n, np.int64)
        tables = None
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node[pick] - first
            # right children are counted, left ones are what their parents have beyond that
            rows = np.flatnonzero(local % 2) if level else np.arange(len(pick))
            half = max(1, count // 2)
            at = cells[rows] + (local[rows] // 2 * width)[:, None]
            found = np.bincount(at.ravel(), np.repeat(value[rows], len(columns)), half * width).reshape(half, len(columns), bins)
            tables = np.stack([tables - found, found], 1).reshape(count, len(columns), bins) if level else found
            c = np.round(tables / one)
            sl, cl = (tables - c * one).cumsum(2), c.cumsum(2)
            st, ct = sl[..., -1:], cl[..., -1:]
            gain = sl**2 / (cl + l2) + (st - sl) ** 2 / (ct - cl + l2) - st**2 / (ct + l2)
            gain[(cl < least) | (ct - cl < least)] = 0
            flat = gain.reshape(count, width)
            best = flat.argmax(1)
            good = flat[np.arange(count), best] > 1e-9
            out.feature[t, first : first + count] = np.where(good, columns[best // bins], -1)
            out.cut[t, first : first + count] = best % bins
            f, k = out.feature[t][node], out.cut[t][node]
            node = 2 * node + 1 + ((f >= 0) & (binned[np.arange(n), np.maximum(f, 0)] > k))
        leaf = node - inner
        s, c = np.bincount(leaf[pick], left[pick], leaves), np.bincount(leaf[pick], minlength=leaves)
        out.value[t] = rate * s / (c + l2)
        score += out.value[t][leaf]
    return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best non-decreasing function of x for y (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    xs, ys = x[order], y[order].astype(float)
    blocks: list[list[float]] = []  # sum, weight, first x, last x
    for a, b in zip(xs, ys):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, w, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = last
    knots = np.array([[(f + l) / 2, s / w] for s, w, f, l in blocks])
    return knots[:, 0], knots[:, 1]
