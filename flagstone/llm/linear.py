"""Sparse rows in numpy and logistic models on them, for fits on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse rows: row i has columns[first[i]:first[i+1]] with the values beside them."""

    first: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def sums(self, cells: np.ndarray) -> np.ndarray:
        """Sums of a value per cell, by row."""
        if cells.ndim == 1:
            return np.bincount(self.owner, cells, minlength=len(self))
        return np.stack([self.sums(c) for c in cells.T], axis=1)

    def take(self, rows: np.ndarray) -> Rows:
        lengths = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(lengths)])
        cells = np.arange(first[-1]) + np.repeat(self.first[:-1][rows] - first[:-1], lengths)
        return Rows(first, self.columns[cells], self.values[cells])

    def only(self, keep: np.ndarray) -> Rows:
        """The rows with the columns of a mask."""
        held = keep[self.columns]
        counts = np.bincount(self.owner[held], minlength=len(self))
        first = np.concatenate([[0], np.cumsum(counts)])
        return Rows(first, self.columns[held], self.values[held])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Linear:
    """Logistic model: weights of hashed columns, of dense inputs, and a bias."""

    weights: np.ndarray
    dense: np.ndarray
    bias: float

    def margin(self, rows: Rows, dense: np.ndarray) -> np.ndarray:
        return rows.sums(self.weights[rows.columns] * rows.values) + dense @ self.dense + self.bias

    def probability(self, rows: Rows, dense: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(rows, dense))


def fit_linear(
    rows: Rows,
    dense: np.ndarray,
    labels: np.ndarray,
    row_weights: np.ndarray,
    width: int,
    rounds: int = 150,
    l1: float = 2e-4,
    min_rows: int = 4,
    step: float = 0.5,
) -> Linear:
    """Full-batch gradient steps with a diagonal scale and an L1 shrinkage.

    Columns in fewer than `min_rows` rows, or as frequent in both classes, keep weight 0.
    """
    n = max(len(rows), 1)
    seen = np.bincount(rows.columns, minlength=width)
    with_one = np.bincount(rows.columns, labels[rows.owner], minlength=width)
    ones = labels.sum()
    lift = np.log((with_one + 0.5) / (ones + 1)) - np.log(
        (seen - with_one + 0.5) / (len(labels) - ones + 1)
    )
    keep = (seen >= min_rows) & (np.abs(lift) > 1.0)
    used = np.flatnonzero(keep)
    rows = rows.only(keep)
    rows = Rows(rows.first, np.searchsorted(used, rows.columns), rows.values)
    weights, shares = np.zeros(len(used)), np.zeros(dense.shape[1])
    row_weights = row_weights / max(row_weights.sum(), 1e-12)
    rate = float(np.clip((row_weights * labels).sum(), 1e-4, 1 - 1e-4))
    bias = float(np.log(rate / (1 - rate)))
    gathered, gathered_dense, gathered_bias = np.full(len(used), 1e-8), np.full(dense.shape[1], 1e-8), 1e-8
    owner = rows.owner
    for _ in range(rounds):
        margin = np.bincount(owner, weights[rows.columns] * rows.values, minlength=n)[: len(labels)]
        error = (sigmoid(margin + dense @ shares + bias) - labels) * row_weights
        slope = np.bincount(rows.columns, error[owner] * rows.values, minlength=len(used))
        slope_dense, slope_bias = dense.T @ error, error.sum()
        gathered += slope**2
        gathered_dense += slope_dense**2
        gathered_bias += slope_bias**2
        pace = step / np.sqrt(gathered)
        weights -= pace * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - l1 * pace, 0)
        shares -= step * slope_dense / np.sqrt(gathered_dense)
        bias -= step * slope_bias / np.sqrt(gathered_bias)
    out = np.zeros(width)
    out[used] = weights
    return Linear(out, shares, float(bias))


@dataclass
class Factors:
    """Factorisation machine: bias, weight and `k` factors of each column."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def probability(self, rows: Rows) -> np.ndarray:
        """Pairwise terms in linear time: half of (sum of v x) squared less the sum of squares."""
        linear = rows.sums(self.weights[rows.columns] * rows.values)
        scaled = self.factors[rows.columns] * rows.values[:, None]
        pairs = 0.5 * (rows.sums(scaled) ** 2 - rows.sums(scaled**2)).sum(axis=1)
        return sigmoid(self.bias + linear + pairs)


def fit_factors(
    rows: Rows,
    labels: np.ndarray,
    width: int,
    k: int = 8,
    epochs: int = 12,
    batch: int = 256,
    step: float = 0.05,
    l2: float = 1e-5,
    seed: int = 7,
) -> Factors:
    """Mini-batch gradient steps with a diagonal scale on the logistic loss."""
    rng = np.random.default_rng(seed)
    rate = float(np.clip(labels.mean() if len(labels) else 0.5, 0.02, 0.98))
    model = Factors(
        float(np.log(rate / (1 - rate))), np.zeros(width), rng.normal(0, 0.02, (width, k))
    )
    of_weights, of_factors, of_bias = np.full(width, 1e-6), np.full(width, 1e-6), 1e-6
    for _ in range(epochs if len(labels) else 0):
        order = rng.permutation(len(labels))
        for low in range(0, len(order), batch):
            part = order[low : low + batch]
            x, y = rows.take(part), labels[part]
            owner, columns, values = x.owner, x.columns, x.values
            scaled = model.factors[columns] * values[:, None]
            total = x.sums(scaled)
            pairs = 0.5 * (total**2 - x.sums(scaled**2)).sum(axis=1)
            margin = model.bias + x.sums(model.weights[columns] * values) + pairs
            error = (sigmoid(margin) - y) / len(part)
            cell = error[owner] * values
            used, place = np.unique(columns, return_inverse=True)
            slope = np.bincount(place, cell) + l2 * model.weights[used]
            change = cell[:, None] * (total[owner] - scaled)
            slopes = np.stack([np.bincount(place, c) for c in change.T], axis=1)
            slopes += l2 * model.factors[used]
            of_weights[used] += slope**2
            of_factors[used] += (slopes**2).mean(axis=1)
            of_bias += error.sum() ** 2
            model.weights[used] -= step * slope / np.sqrt(of_weights[used])
            model.factors[used] -= step * slopes / np.sqrt(of_factors[used])[:, None]
            model.bias -= step * error.sum() / np.sqrt(of_bias)
    return model
