"""Bounded samples of labelled documents, and the logistic fit the two classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmart.llm.common import remainder

# A fit reads at most so many documents of each class, each of at most so many bytes.
# Scoring has no such limits: it covers every byte of every document.
SAMPLE_DOCS = 2_000
SAMPLE_BYTES = 1 << 16


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    divisor: int,
    held_out: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_docs: int = SAMPLE_DOCS,
) -> list[tuple[bytes, int]]:
    """Texts and labels of at most `n_docs` documents per class, chosen by a hash of the id.

    Documents of the held-out fold are never read. Rows without a label are left out.
    """
    learn = labels.where((remainder(F.col(id_col), divisor) != held_out) & F.col(label).isin(0, 1))
    chosen = [
        learn.where(F.col(label) == value).orderBy(F.xxhash64(id_col, F.lit("sample"))).limit(n_docs)
        .select(F.col(id_col).alias("_id"), F.col(label).alias("_label"))
        for value in (0, 1)
    ]
    ids = chosen[0].unionAll(chosen[1]).dropDuplicates(["_id"])
    rows = (
        docs.join(F.broadcast(ids), docs[id_col] == F.col("_id"))
        .where(F.octet_length(docs[text_col]) <= SAMPLE_BYTES)
        .select("_id", docs[text_col].cast("binary").alias("_text"), "_label")
        .limit(2 * n_docs)
        .collect()
    )
    rows.sort(key=lambda r: (r["_id"], bytes(r["_text"])))
    return [(bytes(r["_text"]), int(r["_label"])) for r in rows]


def fit_logistic(
    features: np.ndarray, labels: np.ndarray, rounds: int = 200, penalty: float = 1e-3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps for a logistic model on standardised features: mean, scale and weights.

    The classes weigh the same, whatever their share. Without rows the weights are zero.
    """
    n_features = features.shape[1]
    if not len(labels):
        return np.zeros(n_features), np.ones(n_features), np.zeros(n_features + 1)
    mean, scale = features.mean(0), features.std(0) + 1e-6
    x = np.column_stack([(features - mean) / scale, np.ones(len(labels))])
    share = max(labels.mean(), 1e-6)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / max(1 - share, 1e-6))
    w = np.zeros(n_features + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - labels)) / len(labels) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x / len(labels)
        step = np.linalg.solve(curve + penalty * np.eye(n_features + 1), gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def logistic(features: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, w = model
    z = (features - mean) / scale @ w[:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
