"""Bagged decision trees on a bounded sample, as arrays that travel to the executors."""

from __future__ import annotations

import numpy as np

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # feature (-1: leaf), cut, left child, leaf value


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, rng: np.random.Generator, depth: int, least: int, bins: int, tries: int) -> Tree:
    feature, cut, left, value = [], [], [], []

    def node(rows: np.ndarray, level: int) -> int:
        at = len(feature)
        feature.append(-1), cut.append(0.0), left.append(-1)
        total, pos = w[rows].sum(), (w[rows] * y[rows]).sum()
        value.append((pos + 0.5) / (total + 1.0))
        if level == depth or total < 2 * least or pos <= 0 or pos >= total:
            return at
        best = (1e-9, -1, 0.0)
        base = pos * (total - pos) / total
        for f in rng.choice(x.shape[1], tries, replace=False):
            v = x[rows, f]
            edges = np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))
            if not len(edges):
                continue
            k = np.searchsorted(edges, v, side="left")
            n = np.bincount(k, w[rows], len(edges) + 1).cumsum()[:-1]
            p = np.bincount(k, w[rows] * y[rows], len(edges) + 1).cumsum()[:-1]
            ok = (n >= least) & (total - n >= least)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = base - p * (n - p) / n - (pos - p) * (total - n - pos + p) / (total - n)
            gain = np.where(ok, gain, -1.0)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (float(gain[i]), int(f), float(edges[i]))
        if best[1] < 0:
            return at
        right = x[rows, best[1]] > best[2]
        feature[at], cut[at] = best[1], best[2]
        a = node(rows[~right], level + 1)
        b = node(rows[right], level + 1)
        left[at] = a
        children[at] = b
        return at

    children: dict[int, int] = {}
    node(np.arange(len(y)), 0)
    both = np.array([(a, children.get(i, -1)) for i, a in enumerate(left)], dtype=int)
    return np.array(feature), np.array(cut), both, np.array(value)


def bag(x: np.ndarray, y: np.ndarray, trees: int = 15, depth: int = 6, least: int = 5, bins: int = 32, seed: int = 11) -> list[Tree]:
    """Trees grown each on a bootstrap sample (as weights) with a random half of the features tried at each split."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        w = rng.multinomial(len(y), np.full(len(y), 1 / len(y))).astype(float)
        out.append(grow(x, y.astype(float), w, rng, depth, least, bins, max(1, x.shape[1] // 2)))
    return out


def predict(forest: list[Tree], x: np.ndarray) -> np.ndarray:
    """Mean leaf value over the trees, for each row of ``x``."""
    total = np.zeros(len(x))
    for feature, cut, children, value in forest:
        at = np.zeros(len(x), int)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            rows = np.flatnonzero(inner)
            go = (x[rows, f[rows]] > cut[at[rows]]).astype(int)
            at[rows] = children[at[rows], go]
        total += value[at]
    return total / max(1, len(forest))
