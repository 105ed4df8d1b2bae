"""Logistic regression by Newton steps, for small feature sets."""

from __future__ import annotations

import numpy as np

STEPS = 25


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def curvature(
    x: np.ndarray, labels: np.ndarray, weights: np.ndarray, beta: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log-likelihood; sums over rows, so parts of the rows can be added up."""
    p = sigmoid(x @ beta)
    return x.T @ (weights * (labels - p)), (x * (weights * p * (1 - p))[:, None]).T @ x


def newton_step(
    beta: np.ndarray, gradient: np.ndarray, curve: np.ndarray, ridge: float
) -> tuple[np.ndarray, float]:
    """The moved coefficients, and the largest move; the intercept, which comes last, is not shrunk."""
    penalty = np.full(len(beta), ridge)
    penalty[-1] = 1e-6
    step = np.linalg.solve(curve + np.diag(penalty), gradient - penalty * beta)
    longest = float(np.abs(step).max())
    # Long steps overshoot where classes are nearly separable.
    return beta + step * min(1.0, 5.0 / max(longest, 1e-12)), longest


def with_intercept(features: np.ndarray) -> np.ndarray:
    return np.column_stack([features, np.ones(len(features))]).astype(np.float64)


def fit(
    features: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1.0
) -> np.ndarray:
    """Coefficients, the intercept last; the intercept is not shrunk."""
    x = with_intercept(features)
    w = np.ones(len(x)) if weights is None else weights
    beta = np.zeros(x.shape[1])
    for _ in range(STEPS):
        beta, longest = newton_step(beta, *curvature(x, labels, w, beta), ridge)
        if longest < 1e-6:
            break
    return beta


def logits(features: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return features @ beta[:-1] + beta[-1]
