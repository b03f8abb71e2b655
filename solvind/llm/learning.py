"""What the classifiers share: bounded labelled samples and a logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, y, text) of at most `per_label` rows of each label, the same ones in every run.

    `labels` holds the ids that may be learned from. An id with two labels counts as the smaller; null labels and
    labels other than 0 and 1 do not count. Sampled ids number 2 x `per_label` at most, so they are broadcast.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").alias("sampled")).agg(F.min(label).alias("y"))
    order = F.xxhash64("sampled")
    parts = [known.where(F.col("y") == y).orderBy(order, "sampled").limit(per_label) for y in (0, 1)]
    ids = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.join(ids, F.col("doc_id") == F.col("sampled")).select("doc_id", "y", "text")


class Logistic:
    """Logistic regression on a few features, fitted by Newton steps that are halved until the loss falls."""

    def __init__(self, features: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1e-2):
        self.mean, self.spread = features.mean(axis=0), features.std(axis=0) + 1e-9
        x, w = self._scaled(features), np.ones(len(y)) if weights is None else weights
        self.beta = np.zeros(x.shape[1])
        loss = self._loss(x, y, w, ridge, self.beta)
        for _ in range(50):
            p = _logistic(x @ self.beta)
            slope = x.T @ (w * (p - y)) + ridge * self.beta
            curve = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
            step, size = np.linalg.solve(curve, slope), 1.0
            while size > 1e-4 and self._loss(x, y, w, ridge, self.beta - size * step) > loss:
                size /= 2
            self.beta = self.beta - size * step
            before, loss = loss, self._loss(x, y, w, ridge, self.beta)
            if before - loss < 1e-9 * (1 + before):
                break

    def _scaled(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(features)), (features - self.mean) / self.spread])

    @staticmethod
    def _loss(x, y, w, ridge, beta) -> float:
        z = x @ beta
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + ridge * (beta @ beta) / 2)

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return _logistic(self._scaled(features) @ self.beta)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
