"""Labelled training samples and a small logistic calibration, shared by the two text scorers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_unit, stage


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; NULL for a NULL doc_id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def held_out(doc_id: Column, folds: int, held: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == held, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """(text, label) of about ``rows`` labelled documents outside the held-out fold.

    ``rows`` bounds the sample whatever the size of the tables: a label is in it if
    the hash of its doc_id falls below rows / labels. That bound is what lets the
    sample be broadcast to the scan of the documents.
    """
    usable = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
              .filter(~held_out(F.col("doc_id"), folds, held))
              .groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(label).cast("int").alias("__label")))
    share = rows / max(rows, usable.count())
    some = usable.filter(hash_unit(F.lit(17), F.col("__id")) <= share)
    picked = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("text"))
    picked = picked.join(F.broadcast(some), "__id")
    # A text that was copied many times teaches no more than one.
    return stage(picked.groupBy("text").agg(F.max("__label").alias("label")), f"sample-{label}")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """Weights (the last is the constant) of a ridge-penalised logistic regression.

    Newton steps on standardised columns, halved until the penalised likelihood improves.
    """
    if not len(x):
        return np.zeros(x.shape[1] + 1)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-12] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    penalty = np.array([ridge] * x.shape[1] + [1e-6])

    def loss(w):
        m = z @ w
        return float((np.logaddexp(0, m) - y * m).sum() + 0.5 * (penalty * w * w).sum())

    w, here = np.zeros(z.shape[1]), loss(np.zeros(z.shape[1]))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), grad)
        while (there := loss(w - step)) > here and np.abs(step).max() > 1e-9:
            step = step / 2
        if here - there < 1e-9 * max(1.0, abs(here)):
            break
        w, here = w - step, there
    out = np.append(w[:-1] / scale, w[-1])
    out[-1] -= float((w[:-1] / scale * mean).sum())
    return out


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
