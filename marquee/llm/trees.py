"""Gradient-boosted trees with monotonic constraints, kept as flat node arrays.

Training runs on a bounded sample in one process (histograms over quantile
bins, Newton steps on the logistic loss). A node is four array entries; a leaf
points to itself, so scoring is ``depth`` gathers over all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    roots: np.ndarray  # int32, one per tree
    feature: np.ndarray  # int32, per node
    threshold: np.ndarray  # float64, per node; +inf in leaves
    left: np.ndarray  # int32, for values up to the threshold
    right: np.ndarray
    value: np.ndarray  # float64, log-odds added by a leaf
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def train(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int],
    n_trees: int = 40,
    depth: int = 4,
    rate: float = 0.2,
    n_bins: int = 32,
    l2: float = 1.0,
    min_rows: int = 8,
) -> Forest:
    """Fits P(y = 1); ``monotone[f]`` of +1 or -1 makes it rise or fall in feature ``f``.

    Without rows of both classes nothing can be told, so every probability is 0.5.
    """
    both = len(np.unique(y)) == 2
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(prior / (1 - prior))) if both else 0.0
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    sign = np.array([monotone.get(f, 0) for f in range(x.shape[1])])
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    margin = np.full(len(y), base)

    def leaf(value: float) -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), value])
        return len(nodes) - 1

    def step(g: np.ndarray | float, h: np.ndarray | float, lo: float, hi: float):
        return np.clip(-g / (h + l2), lo, hi)

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int, lo: float, hi: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        here = float(step(g, h, lo, hi))
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * min_rows:
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, grad[rows], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], len(e) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                wl, wr = step(gl, hl, lo, hi), step(g - gl, h - hl, lo, hi)
                gain = -(gl * wl + 0.5 * (hl + l2) * wl**2 + (g - gl) * wr + 0.5 * (h - hl + l2) * wr**2)
                gain += g * here + 0.5 * (h + l2) * here**2
                fine = (nl >= min_rows) & (len(rows) - nl >= min_rows) & (sign[f] * (wr - wl) >= 0)
                k = int(np.argmax(np.where(fine, gain, -np.inf)))
                if fine[k] and gain[k] > best[0]:
                    best = (gain[k], (f, k, float(wl[k]), float(wr[k])))
        if best[1] is None:
            return leaf(here * rate)
        f, k, wl, wr = best[1]
        middle = (wl + wr) / 2
        bounds_l, bounds_r = (lo, hi), (lo, hi)
        if sign[f] > 0:
            bounds_l, bounds_r = (lo, middle), (middle, hi)
        elif sign[f] < 0:
            bounds_l, bounds_r = (middle, hi), (lo, middle)
        goes_left = binned[rows, f] <= k
        at = leaf(0.0)
        left = grow(rows[goes_left], grad, hess, level + 1, *bounds_l)
        right = grow(rows[~goes_left], grad, hess, level + 1, *bounds_r)
        nodes[at] = [f, float(edges[f][k]), left, right, 0.0]
        return at

    def forest(of: list[int]) -> Forest:
        table = np.array(nodes, dtype=np.float64).reshape(-1, 5)
        ints = [table[:, c].astype(np.int32) for c in (0, 2, 3)]
        return Forest(np.array(of, np.int32), ints[0], table[:, 1], ints[1], ints[2], table[:, 4], depth, base)

    if both:
        for _ in range(n_trees):
            p = 1.0 / (1.0 + np.exp(-margin))
            roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -4.0, 4.0))
            tree = forest(roots[-1:])
            margin += tree.margin(x) - base
    return forest(roots)
