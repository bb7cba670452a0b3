"""Sparse linear classifiers trained by follow-the-regularised-leader with elastic-net penalties.

Examples are rows of (feature index, value) pairs in one flat array, with the place where each
row starts. Each coordinate keeps the sum of its gradients and of their squares; its weight is
zero until the sum passes the absolute penalty. Training runs over a bounded sample in one task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Examples(NamedTuple):
    index: np.ndarray
    value: np.ndarray
    start: np.ndarray  # one more than there are rows

    def take(self, rows: np.ndarray) -> Examples:
        size = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[rows] - start[:-1], size) + np.arange(start[-1])
        return Examples(self.index[at], self.value[at], start)


def examples(rows: list[tuple[np.ndarray, np.ndarray]]) -> Examples:
    start = np.concatenate([[0], np.cumsum([len(i) for i, _ in rows], dtype=np.int64)]).astype(np.int64)
    empty = np.zeros(0)
    return Examples(np.concatenate([empty, *(i for i, _ in rows)]).astype(np.int64), np.concatenate([empty, *(v for _, v in rows)]), start)


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def margins(x: Examples, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """One row for each example, one column for each class."""
    total = np.zeros((len(x.index) + 1, weight.shape[1]))
    np.cumsum(weight[x.index] * x.value[:, None], axis=0, out=total[1:])
    return total[x.start[1:]] - total[x.start[:-1]] + bias


def train(x: Examples, y: np.ndarray, n_classes: int, n_features: int, l1: float, l2: float, alpha: float = 0.5, beta: float = 1.0,
          epochs: int = 4, batch: int = 32, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features by classes, mostly zero) and biases of a multinomial logistic regression."""
    z, n = np.zeros((n_features + 1, n_classes)), np.zeros((n_features + 1, n_classes))
    weight = np.zeros((n_features + 1, n_classes))  # the last row is the bias and is not penalised
    order = np.random.default_rng(seed)
    n_rows = len(x.start) - 1
    for _ in range(epochs):
        shuffled = order.permutation(n_rows)
        for at in range(0, n_rows, batch):
            rows = shuffled[at:at + batch]
            own = x.take(rows)
            error = softmax(margins(own, weight[:-1], weight[-1]))
            error[np.arange(len(rows)), y[rows]] -= 1
            used, back = np.unique(own.index, return_inverse=True)
            each = np.repeat(error, np.diff(own.start), axis=0) * own.value[:, None]
            gradient = np.stack([np.bincount(back, each[:, c], len(used)) for c in range(n_classes)], axis=1)
            used, gradient = np.append(used, n_features), np.vstack([gradient, error.sum(axis=0)])
            square = n[used] + gradient ** 2
            z[used] += gradient - (np.sqrt(square) - np.sqrt(n[used])) / alpha * weight[used]
            n[used] = square
            penalty = np.append(np.full(len(used) - 1, l1), 0.0)[:, None]
            rate = (beta + np.sqrt(square)) / alpha + np.append(np.full(len(used) - 1, l2), 0.0)[:, None]
            weight[used] = np.where(np.abs(z[used]) > penalty, -(z[used] - np.sign(z[used]) * penalty) / rate, 0.0)
    return weight[:-1], weight[-1]


def temperature(margin: np.ndarray, y: np.ndarray) -> float:
    """The factor that makes softmax(margin / T) most likely for the given classes, by golden section on log T."""
    def loss(log_t: float) -> float:
        p = softmax(margin / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    if not len(y):
        return 1.0
    low, high, step = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
