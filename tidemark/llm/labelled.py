"""Bounded samples of labelled texts, and a logistic curve fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SAMPLE_CHARS = 200_000


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows_per_class: int,
    salt: str,
    max_chars: int = MAX_SAMPLE_CHARS,
) -> DataFrame:
    """(doc_id, text, label) of at most ``rows_per_class`` labelled ids per class 0 and 1.

    Ids are taken in the order of a salted hash, so the sample is the same on every run.
    Rows without id, text or label are left out, as are texts above ``max_chars``, which
    bounds the sample to 2 x rows_per_class x max_chars characters.  Ids labelled twice
    count by their larger label.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .withColumn("place", F.xxhash64(F.col("doc_id").cast("string"), F.lit(salt)))
    )
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy("place").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.length("text") <= max_chars)
    # at most 2 x rows_per_class ids and numbers
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", "place")


def learning_row(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5 is not 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of the columns of ``x``, the last for a constant; balanced by nothing.

    With a single class, or none, the constant states the smoothed share of ones.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return w
    scale = x.std(axis=0)
    scale[scale == 0] = 1
    centre = x.mean(axis=0)
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    out = np.append(w[:-1] / scale, w[-1] - (w[:-1] * centre / scale).sum())
    return out


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -35, 35)))
