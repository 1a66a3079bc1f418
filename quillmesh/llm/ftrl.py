"""Multinomial logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

import numpy as np


def train(rows: list, labels: np.ndarray, classes: int, dims: int, alpha: float = 0.5,
          beta: float = 1.0, l1: float = 0.5, l2: float = 1.0, epochs: int = 4) -> tuple:
    """(weights dims x classes, bias): elastic-net weights of sparse rows.

    ``rows`` are (indices, values) with distinct indices. Every weight has its
    own step, from the sum of its squared gradients; l1 keeps rare ones at 0.
    """
    z, n = np.zeros((dims, classes)), np.zeros((dims, classes))
    bias, bias_n = np.zeros(classes), np.zeros(classes)
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for row in order.permutation(len(rows)):
            at, value = rows[row]
            w = _weights(z[at], n[at], alpha, beta, l1, l2)
            error = softmax(value @ w + bias)
            error[labels[row]] -= 1.0
            gradient = value[:, None] * error
            squares = gradient * gradient
            root = np.sqrt(n[at])
            z[at] += gradient - (np.sqrt(n[at] + squares) - root) / alpha * w
            n[at] += squares
            bias_n += error * error
            bias -= alpha * error / (beta + np.sqrt(bias_n))
    return _weights(z, n, alpha, beta, l1, l2), bias


def _weights(z, n, alpha, beta, l1, l2):
    shrunk = np.sign(z) * l1 - z
    return np.where(np.abs(z) <= l1, 0.0, shrunk / ((beta + np.sqrt(n)) / alpha + l2))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """What to divide logits by for the best likelihood of held-back labels."""
    if not len(labels):
        return 1.0
    tried = np.geomspace(0.05, 20.0, 121)
    likely = [np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-300).sum() for t in tried]
    return float(tried[int(np.argmax(likely))])
