"""Logistic regression on small dense tables, and samples of labelled documents of a bounded size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the intercept last, by Newton's method with a ridge penalty; ``weight`` is what each row counts."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.diag(ridge), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fold(doc_id: Column, parts: int) -> Column:
    """The part of the split that a document belongs to: the CRC of its doc_id as text; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, use: Column, per_class: int, max_bytes: int
) -> tuple[list[tuple[bytes, int]], dict[int, int]]:
    """(text, label) of at most ``per_class`` labelled documents of each class, in the order of a hash of their doc_id.

    ``use`` says which labels may be learned from. A document with several labels counts with the largest, null labels and
    labels without a document don't count. Texts end when a class has ``max_bytes``; a text is taken whole or not.
    The numbers of known labels by class come with the sample.
    """
    known = labels.where(use & F.col(label).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    known = known.where("id IS NOT NULL").groupBy("id").agg(F.max("y").alias("y")).withColumn("h", F.md5(F.col("id").cast("string")))
    totals = {0: 0, 1: 0} | {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    ids = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy("h", "id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")
    rows = sorted((r.h, r.id, (r.text or "").encode(), r.y) for r in texts.collect())
    room, out = {0: max_bytes, 1: max_bytes}, []
    for _, _, body, y in rows:
        if room[y] > 0:
            room[y] -= len(body)
            out.append((body, y))
    return out, totals
