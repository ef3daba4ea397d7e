"""Multinomial logistic regression on sparse rows, fitted by
follow-the-regularised-leader (proximal, per-coordinate rates) with an
elastic-net penalty; and temperature calibration. Used on bounded samples."""

from __future__ import annotations

import numpy as np


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, classes: int, size: int, *,
        weight: np.ndarray | None = None, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.05, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """rows: (indices, values). -> (weights [size, classes], bias [classes]).

    z and n are the sums of FTRL; a weight is zero while |z| <= l1 (the lasso
    part), else it shrinks with l2 (the ridge part). The bias has no penalty.
    """
    z = np.zeros((size + 1, classes))
    n = np.zeros((size + 1, classes))
    pen1 = np.full((size + 1, 1), l1)
    pen2 = np.full((size + 1, 1), l2)
    pen1[size] = pen2[size] = 0

    def current(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - pen1[i], 0)
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + pen2[i])

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i, v = rows[k]
            i = np.append(i, size)
            v = np.append(v, 1.0)
            w = current(i)
            g = softmax(v @ w)
            g[label[k]] -= 1
            if weight is not None:
                g = g * weight[k]
            step = v[:, None] * g[None, :]
            grown = n[i] + step * step
            z[i] += step - (np.sqrt(grown) - np.sqrt(n[i])) / alpha * w
            n[i] = grown
    w = current(np.arange(size + 1))
    return w[:size], w[size]


def temperature(logits: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The divisor of the logits that makes held-back labels likeliest (golden section on its logarithm)."""
    if not len(logits):
        return 1.0
    wt = np.ones(len(label)) if weight is None else weight

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -float((wt * np.log(np.maximum(p[np.arange(len(label)), label], 1e-12))).sum())

    a, b, r = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))
