"""Histogram gradient-boosted trees for a yes/no label, in flat numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.15
RIDGE = 1.0
LEAST_HESSIAN = 2.0


@dataclass
class Trees:
    """Complete trees: the children of node i are 2i + 1 and 2i + 2.

    ``feature`` and ``threshold`` are (trees, inner nodes); a value above the
    threshold goes right. An inner node without a split has threshold infinity.
    ``leaf`` is (trees, leaves), in log-odds.
    """

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row, all rows at a time, level by level."""
        odds = np.full(len(rows), self.base)
        inner = self.feature.shape[1]
        every = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), dtype=np.int64)
            while len(node) and node[0] < inner:
                right = rows[every, feature[node]] > threshold[node]
                node = 2 * node + 1 + right
            odds += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-odds))


def _edges(column: np.ndarray) -> np.ndarray:
    """Bin borders: values of the sample at even ranks, without repeats or the largest."""
    marks = np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")
    marks = np.unique(marks)
    return marks[marks < column.max()]


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Trees for 0/1 labels. Without both labels there is nothing to split on, and
    every score is the share of label 1 (a half without any rows)."""
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    share = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6)) if len(labels) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        empty = np.zeros((0, inner))
        return Trees(base, empty.astype(np.int64), empty, np.zeros((0, leaves)))
    count = rows.shape[1]
    edges = [_edges(rows[:, f]) for f in range(count)]
    binned = np.stack([np.searchsorted(e, rows[:, f]) for f, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(count) * BINS
    odds = np.full(len(rows), base)
    grown = []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-odds))
        gradient, hessian = chance - labels, chance * (1 - chance)
        node = np.zeros(len(rows), dtype=np.int64)
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)
        for depth in range(DEPTH):
            first, wide = (1 << depth) - 1, 1 << depth
            at = ((node - first) * (count * BINS))[:, None] + flat
            shape = (wide, count, BINS)
            sums = [
                np.bincount(at.ravel(), np.repeat(v, count), minlength=wide * count * BINS)
                .reshape(shape)
                .cumsum(axis=2)
                for v in (gradient, hessian)
            ]
            (gl, hl), (g, h) = sums, [s[:, :, -1:] for s in sums]
            gain = gl**2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g**2 / (h + RIDGE)
            gain[(hl < LEAST_HESSIAN) | (h - hl < LEAST_HESSIAN)] = 0
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = 0
            best = gain.reshape(wide, -1).argmax(axis=1)
            for n, b in enumerate(best):
                f, cut = divmod(int(b), BINS)
                if gain[n, f, cut] > 1e-9:
                    feature[first + n], threshold[first + n] = f, edges[f][cut]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > threshold[node])
        leaf_of = node - inner
        g = np.bincount(leaf_of, gradient, minlength=leaves)
        h = np.bincount(leaf_of, hessian, minlength=leaves)
        leaf = -RATE * g / (h + RIDGE)
        odds += leaf[leaf_of]
        grown.append((feature, threshold, leaf))
    return Trees(base, *(np.stack(part) for part in zip(*grown)))
