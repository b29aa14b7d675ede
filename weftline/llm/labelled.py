"""Bounded samples of labelled documents for fitting classifiers on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import fresh

#: Rows of each class in a fitting sample.
SAMPLE_ROWS = 3_000
#: Longer texts are left out of fitting samples (they are scored like all others).
SAMPLE_BYTES = 64_000


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from fitting: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> tuple[list[tuple[int, str, str | None]], np.ndarray, np.ndarray]:
    """((doc_id, text, lang) of each row, labels, weights) of at most `rows` documents of each class.

    The rows are those with the smallest hashes of doc_id among labelled documents that aren't held out, so the
    sample doesn't depend on how tables are partitioned; weights restore each class's share of all labels. Of
    contradictory labels of a document the larger counts, of several texts of a doc_id the least.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    totals = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    order = fresh("order")
    ids = None
    for y in sorted(totals):
        part = known.where(F.col("y") == y).withColumn(order, F.xxhash64("doc_id")).orderBy(order, "doc_id").limit(rows)
        ids = part if ids is None else ids.union(part)
    if ids is None:
        return [], np.empty(0), np.empty(0)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), lang.cast("string").alias("lang"))
    found = texts.where(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(ids.select("doc_id", "y")), "doc_id")
    found = found.groupBy("doc_id", "y").agg(F.min(F.struct("text", F.coalesce("lang", F.lit("")).alias("lang"))).alias("row")).select("doc_id", "row.text", "row.lang", "y").collect()  # at most 2 x rows, short
    found = sorted((r.doc_id, r.text, r.lang, r.y) for r in found)
    y = np.array([r[3] for r in found], dtype=float)
    counts = {k: max(1.0, float((y == k).sum())) for k in totals}
    weights = np.array([totals[int(k)] / counts[int(k)] for k in y])
    return [r[:3] for r in found], y, weights / max(1e-12, weights.mean() if len(weights) else 1.0)


def sigmoid(z: np.ndarray | float) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def platt(scores: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic calibration (Platt, 1999): smoothed targets, Newton's method."""
    y = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    x = np.stack([scores, np.ones_like(scores)], axis=1)
    at = np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((weights * (np.logaddexp(0, z) - y * z)).sum() + 0.05 * ((v - [1.0, 0.0]) ** 2).sum())

    for _ in range(rounds):
        p = sigmoid(x @ at)
        gradient = x.T @ (weights * (p - y)) + 0.1 * (at - [1.0, 0.0])
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        while loss(at - step) > loss(at) and np.abs(step).max() > 1e-9:
            step /= 2
        at = at - step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(at[0]), 1e-3), float(at[1])
