"""Byte-level convolutional quality classifier in numpy.

A text's UTF-8 bytes pass through learned filters of `WIDTH` bytes. Activations are max-pooled in chunks of
`2 x HALF` bytes, each overlapping the next by half and together covering the whole document; the mean and the
maximum over the chunks are combined into one probability. Filters, combination and calibration are fitted on
the driver from a bounded sample of labelled rows (see `labelled`); scoring is one pass without a shuffle.

Defined cases: a null text is empty; texts shorter than a filter are padded with zero bytes; without labels of
both classes every score is the smoothed share of label 1; a very long text is scored whole, in slabs of a fixed size;
an empty table gives no rows; repeated rows are scored each for itself, equal texts alike; input columns other than doc_id and text are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import labelled
from weftline.llm.common import let_go, map_batches

WIDTH, FILTERS, EMBEDDED = 6, 24, 8
HALF = 256
#: Bytes that pass through the filters at a time; longer texts go piece by piece.
SLAB = 256 * HALF
EPOCHS, BATCH, RATE = 14, 48, 0.01
#: Batches that a small sample is fitted with at least.
STEPS = 400
THRESHOLD = 0.7


def padded(text: bytes) -> np.ndarray:
    """Bytes in rows of HALF, each followed by the WIDTH - 1 bytes that its last windows reach into."""
    n = max(1, -(-len(text) // HALF))
    return np.frombuffer(text + bytes(n * HALF + WIDTH - 1 - len(text)), dtype=np.uint8)


def starts(size: int) -> int:
    """Windows of a text: at least one, which may reach into the padding."""
    return max(1, size - WIDTH + 1)


@dataclass
class Model:
    tables: np.ndarray  # (WIDTH, 256, FILTERS): byte embedding times filter
    bias: np.ndarray
    mean: np.ndarray
    top: np.ndarray
    offset: float
    slope: float = 1.0
    intercept: float = 0.0
    constant: float | None = None

    def halves(self, text: bytes) -> np.ndarray:
        """Largest activation of each filter in each half chunk."""
        out = []
        flat = padded(text)
        last = starts(len(text))
        for at in range(0, len(flat) - WIDTH + 1, SLAB):
            piece = flat[at : at + SLAB + WIDTH - 1]
            n = len(piece) - WIDTH + 1
            z = self.tables[0][piece[:n]]
            for k in range(1, WIDTH):
                z += self.tables[k][piece[k : k + n]]
            if at + n > last:
                z[max(0, last - at) :] = -1e9
            out.append(z.reshape(-1, HALF, z.shape[1]).max(axis=1))
        return np.concatenate(out) if len(out) > 1 else out[0]

    def logit(self, text: bytes) -> float:
        half = self.halves(text)
        half = half[: -(-starts(len(text)) // HALF)]
        chunk = np.maximum(half[:-1], half[1:]) if len(half) > 1 else half
        chunk = np.maximum(chunk + self.bias, 0)
        return float(chunk.mean(axis=0) @ self.mean + chunk.max(axis=0) @ self.top + self.offset)

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        return float(labelled.sigmoid(self.slope * self.logit(text) + self.intercept))


def fit(texts: list[bytes], y: np.ndarray, weights: np.ndarray, seed: int = 0) -> Model:
    """Adam over shuffled batches; every fifth row is kept for the calibration."""
    share = float((weights * y).sum() + 1) / float(weights.sum() + 2) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    shapes = {"embedding": (256, EMBEDDED), "filters": (WIDTH, EMBEDDED, FILTERS), "bias": (FILTERS,), "mean": (FILTERS,), "top": (FILTERS,)}
    p = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()}
    p["bias"][:] = 0
    p["offset"] = np.zeros(1, dtype=np.float32)

    def model() -> Model:
        return Model(np.einsum("be,kef->kbf", p["embedding"], p["filters"]).astype(np.float32), p["bias"], p["mean"], p["top"], float(p["offset"][0]))

    if len(y) < 10 or y.min() == y.max():
        out = model()
        out.constant = share
        return out
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    kept = np.arange(len(y)) % 5 == 0
    train, step = np.flatnonzero(~kept), 0
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(train)))
    for epoch in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            gradient = {k: np.zeros_like(v) for k, v in p.items()}
            now = model()
            g_tables = np.zeros_like(now.tables)
            batch = train[at : at + BATCH]
            total = weights[batch].sum()
            for i in batch:
                text = texts[i]
                flat, last = padded(text), starts(len(text))
                n = len(flat) - WIDTH + 1
                z = now.tables[0][flat[:n]]
                for k in range(1, WIDTH):
                    z += now.tables[k][flat[k : k + n]]
                z[last:] = -1e9
                z = z.reshape(-1, HALF, FILTERS)[: -(-last // HALF)]
                where = z.argmax(axis=1)
                half = np.take_along_axis(z, where[:, None], axis=1)[:, 0]
                where += np.arange(len(half))[:, None] * HALF
                if len(half) > 1:
                    right = half[1:] > half[:-1]
                    where, half = np.where(right, where[1:], where[:-1]), np.maximum(half[:-1], half[1:])
                act = np.maximum(half + now.bias, 0)
                top = act.argmax(axis=0)
                mean, most = act.mean(axis=0), act.max(axis=0)
                error = weights[i] / total * (labelled.sigmoid(mean @ now.mean + most @ now.top + now.offset) - y[i])
                gradient["offset"] += error
                gradient["mean"] += error * mean
                gradient["top"] += error * most
                g = np.repeat((error * now.mean / len(act))[None], len(act), axis=0)
                g[top, np.arange(FILTERS)] += error * now.top
                g *= act > 0
                gradient["bias"] += g.sum(axis=0)
                column = np.arange(FILTERS)
                for k in range(WIDTH):
                    np.add.at(g_tables[k], (flat[where + k], column[None]), g)
            gradient["embedding"] = np.einsum("kbf,kef->be", g_tables, p["filters"])
            gradient["filters"] = np.einsum("kbf,be->kef", g_tables, p["embedding"])
            step += 1
            rate = RATE * (1 - epoch / epochs) + RATE / 20
            for k, v in p.items():
                g = gradient[k] + 1e-4 * v
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                v -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(v.dtype)
    out = model()
    out.slope, out.intercept = labelled.platt(np.array([out.logit(texts[i]) for i in np.flatnonzero(kept)]), y[kept], weights[kept])
    return out


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows, y, weights = labelled.sample(docs, labels, "quality")
    model = fit([r[1].encode("utf-8", "replace") for r in rows], y, weights)
    del rows
    let_go()
    return model


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [shared.value.score(t) for t in batch.column(2).to_pylist()]
        predicted = pa.array([int(v >= threshold) for v in values], pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.float64()), predicted], names=["doc_id", "held_out", "score", "predicted"])

    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), labelled.held_out(doc_id).alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return map_batches(rows, work, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without those that score under the threshold; all of them where there are no labels of both classes."""
    model = train(docs, labels)
    if model.constant is not None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = [shared.value.score((t or "").encode("utf-8", "replace")) >= threshold for t in batch.column(at).to_pylist()]
        return batch.filter(pa.array(good, pa.bool_()))

    return map_batches(docs, work, docs.schema)
