"""Logistic regression by Newton steps, for fits on bounded samples."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Logistic:
    """Weights over standardised features and an intercept."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights + self.intercept

    def column(self, features: str) -> Column:
        """The same log odds as an expression over an array column; the weights enter the plan as one literal."""
        slopes = self.weights / self.scale
        return weighted_sum(F.col(features), slopes, float(self.intercept - self.mean @ slopes))


def weighted_sum(values: Column, weights: np.ndarray, base: float) -> Column:
    """base plus the inner product of an array with weights.

    The weights are one array literal, so plans with other weights compile to the same code.
    """
    products = F.zip_with(values, F.lit([float(w) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(base), lambda total, x: total + x)


def fit_logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, l2: float = 1.0,
                 steps: int = 25) -> Logistic:
    """Weighted fit with an L2 penalty on all but the intercept; classes may be missing."""
    rows, width = features.shape
    weights = np.ones(rows) if weights is None else weights
    mean = features.mean(0) if rows else np.zeros(width)
    scale = features.std(0) if rows else np.ones(width)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = np.c_[(features - mean) / scale, np.ones(rows)]
    beta = np.zeros(width + 1)
    penalty = np.r_[np.full(width, l2), 1e-3]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (labels - p)) - penalty * beta
        curvature = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, beta[:-1], float(beta[-1]))


def log_odds(share: float) -> float:
    share = min(max(share, 1e-4), 1 - 1e-4)
    return math.log(share / (1 - share))
