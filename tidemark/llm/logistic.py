"""Logistic regression on a bounded sample in the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500.0, 500.0)))


def fit(
    rows: np.ndarray, features: np.ndarray, labels: np.ndarray, n_features: int, ridge: float = 1.0, steps: int = 300
) -> tuple[np.ndarray, float]:
    """(weights, bias) for presence features: ``features[k]`` is present in row ``rows[k]``.

    Accelerated gradient steps on the ridge-penalised loss; the step length
    follows from a bound on the curvature, so no line search is needed.
    """
    n = len(labels)
    y = np.asarray(labels, np.float64)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    weights, bias = np.zeros(n_features), float(np.log(share / (1 - share)))
    # largest eigenvalue of X'X by power iteration, the constant included
    probe, constant = np.ones(n_features), 1.0
    top = 1.0
    for _ in range(20):
        out = np.bincount(rows, weights=probe[features], minlength=n) + constant
        probe, constant = np.bincount(features, weights=out[rows], minlength=n_features), out.sum()
        top = float(np.sqrt((probe**2).sum() + constant**2))
        probe, constant = probe / top, constant / top
    step = 1.0 / (0.25 * top * 1.05 + ridge)
    ahead_w, ahead_b, momentum = weights.copy(), bias, 1.0
    for _ in range(steps):
        error = sigmoid(np.bincount(rows, weights=ahead_w[features], minlength=n) + ahead_b) - y
        new_w = ahead_w - step * (np.bincount(features, weights=error[rows], minlength=n_features) + ridge * ahead_w)
        new_b = ahead_b - step * error.sum()
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / faster
        ahead_w, ahead_b = new_w + pull * (new_w - weights), new_b + pull * (new_b - bias)
        weights, bias, momentum = new_w, float(new_b), faster
    return weights, bias


def fit_differences(better: np.ndarray, worse: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Bradley-Terry weights: logistic loss on ``better - worse``, row by row, by Newton steps."""
    x = better - worse
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        chance = sigmoid(x @ weights)
        slope = x.T @ (chance - 1) + ridge * weights
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + ridge * np.eye(len(weights))
        move = np.linalg.solve(curve, slope)
        weights = weights - move
        if np.abs(move).max() < 1e-8:
            break
    return weights
