"""A regularized linear classifier on hashed features, fitted with numpy."""

from __future__ import annotations

import numpy as np

BITS = 17


class Linear:
    """Logistic regression; a row is (feature numbers, values)."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def scores(self, owner: np.ndarray, features: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
        """Log odds of every row; ``owner`` is the row of each feature."""
        return np.bincount(owner, self.weights[features] * values, minlength=rows) + self.bias


def fit(owner: np.ndarray, features: np.ndarray, values: np.ndarray, labels: np.ndarray, l2: float = 1e-5, epochs: int = 6, batch: int = 64, rate: float = 0.5, seed: int = 1) -> Linear:
    """AdaGrad over shuffled batches; both classes weigh the same; rows are sorted by ``owner``."""
    n = len(labels)
    starts = np.searchsorted(owner, np.arange(n + 1))
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    bias, bias_square = 0.0, 1e-6
    positive = max(1, int(labels.sum()))
    weigh = np.where(labels > 0, n / (2 * positive), n / (2 * max(1, n - positive)))
    random = np.random.default_rng(seed)
    for _ in range(epochs if n else 0):
        order = random.permutation(n)
        for k in range(0, n, batch):
            rows = order[k : k + batch]
            spans = [np.arange(starts[r], starts[r + 1]) for r in rows]
            at = np.concatenate(spans)
            own = np.repeat(np.arange(len(rows)), [len(s) for s in spans])
            f, v = features[at], values[at]
            odds = np.bincount(own, weights[f] * v, minlength=len(rows)) + bias
            error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - labels[rows]) * weigh[rows] / len(rows)
            touched, place = np.unique(f, return_inverse=True)
            grad = np.bincount(place, error[own] * v) + l2 * weights[touched]
            squares[touched] += grad**2
            weights[touched] -= rate * grad / np.sqrt(squares[touched])
            g = float(error.sum())
            bias_square += g * g
            bias -= rate * g / bias_square**0.5
    return Linear(weights, bias)
