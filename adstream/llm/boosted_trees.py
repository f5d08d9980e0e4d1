"""Gradient-boosted trees over histograms, and their traversal as flat arrays, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosting:
    """Trees, their depth and bins, and what keeps them from learning chance."""

    trees: int = 120
    depth: int = 4
    bins: int = 64
    rate: float = 0.08
    least: float = 8.0
    ridge: float = 2.0
    gain: float = 0.5


@dataclass
class Forest:
    """Nodes of all trees in one set of arrays.

    A row at node k goes to ``left[k]`` where its ``feature[k]`` is at most
    ``edge[k]``, else to ``right[k]``; a leaf leads to itself and has a value.
    """

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    edge: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray, rows: int = 2048) -> np.ndarray:
        """The probability of label 1 of each row, all trees at once."""
        made = np.full(len(x), self.base)
        for at in range(0, len(x), rows):
            part = x[at : at + rows]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                low = part[row, self.feature[node]] <= self.edge[node]
                node = np.where(low, self.left[node], self.right[node])
            made[at : at + rows] += self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(made, -40, 40)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each feature, up to ``bins - 1`` values that part its rows evenly."""
    at = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, at, method="lower")) for column in x.T]


def _split(codes, rows, slope, curve, how: Boosting):
    """The best (gain, feature, bin) of a node's rows; gain 0 if none is good enough."""
    features, bins = codes.shape[1], how.bins
    place = (codes[rows] + np.arange(features) * bins).ravel()
    sums = [
        np.bincount(place, np.repeat(v[rows], features), features * bins).reshape(features, bins)
        for v in (slope, curve)
    ]
    g, h = (s.cumsum(axis=1) for s in sums)
    all_g, all_h = g[:, -1:], h[:, -1:]
    rest_g, rest_h = all_g - g, all_h - h
    gain = g**2 / (h + how.ridge) + rest_g**2 / (rest_h + how.ridge) - all_g**2 / (all_h + how.ridge)
    gain = np.where((h >= how.least / 4) & (rest_h >= how.least / 4), gain, 0)
    best = int(gain.argmax())
    return gain.flat[best], best // bins, best % bins


def learned(x: np.ndarray, label: np.ndarray, weight: np.ndarray, how: Boosting = Boosting()) -> Forest:
    """Trees for a label of 0 or 1, by logistic loss with a weight for each row."""
    edges = _edges(x, how.bins)
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    share = np.clip(np.average(label, weights=weight), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots = []
    margin = np.full(len(x), base)
    weight = weight * (len(x) / weight.sum())

    def grow(rows: np.ndarray, depth: int) -> int:
        here = len(nodes)
        g, h = slope[rows].sum(), curve[rows].sum()
        nodes.append([0, 0.0, here, here, -how.rate * g / (h + how.ridge)])
        if depth:
            gain, feature, cut = _split(codes, rows, slope, curve, how)
            if gain > how.gain:
                low = codes[rows, feature] <= cut
                nodes[here][:2] = feature, edges[feature][cut]
                nodes[here][2] = grow(rows[low], depth - 1)
                nodes[here][3] = grow(rows[~low], depth - 1)
                return here
        margin[rows] += nodes[here][4]
        return here

    for _ in range(how.trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = weight * (p - label), weight * p * (1 - p)
        roots.append(grow(np.arange(len(x)), how.depth))
    feature, edge, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    whole = (np.array(roots, np.int64), feature.astype(np.int64), edge.astype(float), left.astype(np.int64))
    return Forest(base, how.depth, *whole, right.astype(np.int64), value)
