"""What the two classifiers share: labelled rows, and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled rows that ``learn`` allows, those of the smallest hash of their id.

    Labels other than 0 and 1, null ids and texts, and ids with contrary labels are left out.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(learn & F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    own = own.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
    taken = own.select("doc_id", "y").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(F.broadcast(taken), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the first column is the constant, which isn't shrunk."""
    w, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    keep[0, 0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x / len(y) + keep, x.T @ (y - p) / len(y) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
