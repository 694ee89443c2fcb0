"""Bounded labelled samples and a small logistic fit, shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_ids(labels: DataFrame, label: str, per_class: dict[int, int], id_col: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """((doc_id, y) of at most ``per_class[y]`` ids of each class, class sizes). Ids
    are taken in the order of a hash, so the sample is bounded and repeatable.
    Rows with a null id or label are left out; of an id labelled twice the
    larger label counts."""
    rows = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y")) \
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in per_class.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, {y: sizes.get(y, 0) for y in per_class}


def one_text_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, y, text) of the sampled ids: one text an id, that with the smallest hash,
    so that an id that repeats without end doesn't make the sample larger."""
    return docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y") \
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge-penalised logistic regression (Newton steps)."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    penalty = np.full(x1.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x1 @ w)
        grad = x1.T @ (weight * (p - y)) + penalty * w
        curve = (x1 * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + np.diag(penalty)
        step = np.linalg.solve(curve, grad)
        w -= step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])
