"""Bounded labelled samples, and logistic regression on their features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, training: Column, per_class: int
) -> DataFrame:
    """text and label (0 or 1) of up to ``per_class`` labelled rows of either class.

    The ids are the first by hash among rows of ``labels`` for which ``training`` holds, and of rows
    that repeat an id the first by hash of id and text are taken, so the choice does not depend on
    partitioning. An id with both labels counts as 1; null ids and labels teach nothing. The chosen
    ids are at most 2 * per_class rows and are broadcast; only texts of chosen rows are shuffled.
    """
    known = (
        labels.where(training & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id")
    chosen = [
        known.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class) for value in (0, 1)
    ]
    chosen = F.broadcast(chosen[0].union(chosen[1]))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    # One id may stand in any number of rows.
    order = F.xxhash64("doc_id", "text")
    bounded = [rows.where(F.col("label") == value).orderBy(order, "text").limit(per_class) for value in (0, 1)]
    return bounded[0].union(bounded[1]).select("text", "label")


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the intercept) by Newton's method; classes weigh what they number."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + penalty * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-6 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights
