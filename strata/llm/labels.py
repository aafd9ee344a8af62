"""Labelled rows of a training table, and a one-dimensional calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels up to this many (9 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_LABELS = 4_000_000


def remainder(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def training_labels(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label 0 or 1) one row per document that is not held out; of
    several labels the highest counts; other values and nulls are left out."""
    return (
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id") != 0))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )


def join_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their labels, by broadcast only while the labels are few."""
    few = labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    return docs.join(F.broadcast(labels) if few else labels, "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-5) -> dict:
    """Weighted ridge logistic regression by Newton steps on standardised columns."""
    weight = weight / weight.sum()
    mean = weight @ x
    spread = np.sqrt(weight @ (x - mean) ** 2) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / spread])
    w = np.zeros(z.shape[1])
    pull = ridge * np.eye(z.shape[1])

    def loss(w):
        m = z @ w
        return weight @ (np.logaddexp(0, m) - y * m) + 0.5 * ridge * w @ w

    for _ in range(200):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + pull, z.T @ (weight * (p - y)) + ridge * w)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(step).max() * size < 1e-8:
            break
    return {"mean": mean, "spread": spread, "w": w}


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -500, 500)))


def apply_logistic(model: dict, x: np.ndarray) -> np.ndarray:
    return sigmoid(model["w"][0] + ((x - model["mean"]) / model["spread"]) @ model["w"][1:])
