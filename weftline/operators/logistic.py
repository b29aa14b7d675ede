"""Logistic regressions of all folds at once, over blocks of pairs.

Features are packed once, about ten thousand pairs to a compressed matrix, and stored. Each Newton step of all folds
is one pass over the blocks: a block adds to the loss and the gradient of each fold that isn't its pairs' own, all
pairs of it, and to the curvature. A start from a bounded sample only saves passes: steps go on until the loss over
all pairs is at its least, or, where the classes can be parted, near enough to nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame

from weftline.checkpoints import checkpoint

#: A fold is done when a step promises less of the mean loss than this; passes at most.
TOLERANCE, PASSES = 1e-7, 500
#: The same for the start: a sample's classes can soon be parted, and a point that is too sure has no curvature to lead back.
START = 1e-3
#: Pairs of the sample of the start, and of a block's at most that its curvature is taken from where more have any.
SAMPLE, CURVED = 40_000, 2_000
#: A pair whose share of the curvature is less has none.
FLAT = 1e-10
CODEC = "zstd"
BLOCK = "ids binary, label binary, fold binary, n int, features binary"
SCORED = "s1_id string, target_id string, label double, fold int, prob double, holdout boolean"


def packer(features: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features])
            if np.isnan(x).any():
                raise ValueError("a feature is missing")
            sink = pa.BufferOutputStream()
            ids = batch.select(["s1_id", "target_id"])
            with pa.ipc.new_stream(sink, ids.schema, options=pa.ipc.IpcWriteOptions(compression=CODEC)) as out:
                out.write_batch(ids)
            label, fold = (batch.column(c).to_numpy(zero_copy_only=False).astype(kind).tobytes() for c, kind in (("label", np.float64), ("fold", np.int32)))
            row = (sink.getvalue().to_pybytes(), label, fold, batch.num_rows, pa.compress(x.tobytes(), CODEC, asbytes=True))
            kinds = (pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["ids", "label", "fold", "n", "features"])

    return pack


def packed(rows: DataFrame, features: list[str]) -> DataFrame:
    """Blocks of (s1_id, target_id, label, fold, features), stored."""
    return checkpoint(rows.select("s1_id", "target_id", "label", "fold", *features).mapInArrow(packer(features), BLOCK))


def matrix(features: bytes, n: int, width: int) -> np.ndarray:
    """(features and a row of ones, pairs)."""
    out = np.ones((width + 1, n))
    out[:width] = np.frombuffer(pa.decompress(features, width * n * 8, CODEC), dtype=np.float64).reshape(width, n)
    return out


def ids_of(block: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(block).read_next_batch()


@dataclass
class Seen:
    """What a first pass tells of the pairs."""

    entities: set[str]  # some, of each partition as many as asked for
    counts: dict[tuple[int, float], int]
    sums: np.ndarray
    squares: np.ndarray

    def __add__(self, other: Seen) -> Seen:
        counts = {k: self.counts.get(k, 0) + other.counts.get(k, 0) for k in self.counts | other.counts}
        return Seen(self.entities | other.entities, counts, self.sums + other.sums, self.squares + other.squares)


def reduced(blocks: DataFrame, columns: tuple[str, ...], function: Callable, zero):
    """The sum over partitions of what `function` makes of their blocks."""
    return blocks.select(*columns).rdd.mapPartitions(lambda rows: [function(rows)]).treeAggregate(zero, lambda a, b: a + b, lambda a, b: a + b)


def look(blocks: DataFrame, width: int, most: int) -> Seen:
    zero = Seen(set(), {}, np.zeros(width + 1), np.zeros(width + 1))

    def seen(rows: Iterable) -> Seen:
        total = zero
        for ids, label, fold, n, features in rows:
            x = matrix(features, n, width)
            known = np.stack([np.frombuffer(fold, np.int32), np.frombuffer(label)])
            kinds, count = np.unique(known, axis=1, return_counts=True)
            entities = set(ids_of(ids).column("s1_id").unique().slice(0, most).to_pylist()) if len(total.entities) < most else set()
            total += Seen(entities, {(int(f), float(y)): int(c) for f, y, c in zip(*kinds, count, strict=True)}, x.sum(axis=1), (x * x).sum(axis=1))
        return Seen(set(sorted(total.entities)[:most]), total.counts, total.sums, total.squares)

    return reduced(blocks, ("ids", "label", "fold", "n", "features"), seen, zero)


def sampled(blocks: DataFrame, width: int, every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every so many-th pair of each block: features, labels, folds."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, fold, n, features in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                some = slice(None, None, every)
                x = np.ascontiguousarray(matrix(features, n, width)[:, some])
                row = (np.frombuffer(label)[some].tobytes(), np.frombuffer(fold, np.int32)[some].tobytes(), x.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in row], names=["label", "fold", "x"])

    found = blocks.select("label", "fold", "n", "features").mapInArrow(chosen, "label binary, fold binary, x binary").collect()
    x = [np.frombuffer(r.x).reshape(width + 1, -1) for r in found]
    return np.concatenate(x, axis=1), np.concatenate([np.frombuffer(r.label) for r in found]), np.concatenate([np.frombuffer(r.fold, np.int32) for r in found])


def slopes(x: np.ndarray, label: np.ndarray, fold: np.ndarray, points: np.ndarray, weights: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """For each fold its loss, gradient and curvature over these pairs, in one row; of folds that are done, nothing.

    `weights` are a fold's of a pair of label 0 and of label 1; pairs of the fold itself have none. Loss and gradient
    are of all pairs; where more than `CURVED` pairs have curvature, an even choice of them stands for all.
    """
    width = len(x)
    out = np.zeros((len(points), 1 + width + width * width))
    some = np.flatnonzero(open_)
    w = np.where(label == 1, weights[some, 1:], weights[some, :1]) * (fold != some[:, None])
    margin = points[some] @ x
    far = np.exp(-np.abs(margin))
    chance = np.where(margin >= 0, 1.0, far) / (1 + far)
    out[some, 0] = (w * (np.log1p(far) + np.maximum(margin, 0) - label * margin)).sum(axis=1)
    out[some, 1 : 1 + width] = (w * (chance - label)) @ x.T
    for k, bent in zip(some, w * far / (1 + far) ** 2, strict=True):
        curved = np.flatnonzero(bent > FLAT)
        if len(curved) > CURVED:
            few = curved[:: -(-len(curved) // CURVED)]
            bent, curved = bent[few] * (bent[curved].sum() / bent[few].sum()), few
        else:
            bent = bent[curved]
        part = x[:, curved]
        out[k, 1 + width :] = ((part * bent) @ part.T).ravel()
    return out


def descend(evaluate: Callable[[np.ndarray, np.ndarray], np.ndarray], points: np.ndarray, totals: np.ndarray, scale: np.ndarray, tolerance: float = TOLERANCE) -> np.ndarray:
    """Newton's method with halved steps from `points` for all folds; `evaluate` sums `slopes` at points of open folds.

    `scale` maps (features, one) to standardised ones. A step solves in these, with a trace of damping for features
    that depend on one another or don't vary.
    """
    width = points.shape[1]
    best, step = points.copy(), np.zeros_like(points)
    least = np.full(len(points), np.inf)
    open_ = totals > 0
    for _ in range(PASSES):
        if not open_.any():
            break
        found = evaluate(best + step, open_)
        for k in np.flatnonzero(open_):
            loss = found[k, 0] / totals[k]
            if not loss < least[k] and np.isfinite(least[k]):  # too far
                step[k] /= 4
                open_[k] = np.abs(step[k]).max() > 1e-12 * (1 + np.abs(best[k]).max())
                continue
            best[k], least[k] = best[k] + step[k], loss
            slope = scale @ found[k, 1 : 1 + width] / totals[k]
            bend = scale @ found[k, 1 + width :].reshape(width, width) @ scale.T / totals[k]
            bend[np.diag_indices(width)] += 1e-9 * max(np.diag(bend).max(), 1e-300)
            move = np.linalg.solve(bend, slope)
            step[k] = -(scale.T @ move)
            open_[k] = slope @ move / 2 > tolerance
    return best


def fit(blocks: DataFrame, width: int, seen: Seen, n: int, weigh: Callable[[int, int], tuple[float, float]]) -> list[tuple[np.ndarray, float]]:
    """(coefficients, intercept) of each of `n` folds, fitted on the other folds' pairs; `weigh` has the weights of both labels by their numbers of pairs."""
    sizes = np.array([[sum(v for (f, y), v in seen.counts.items() if f != k and y == label) for label in (0.0, 1.0)] for k in range(n)])
    weights = np.array([weigh(int(positives), int(negatives)) for negatives, positives in sizes])
    totals = np.where((sizes > 0).all(axis=1), (sizes * weights).sum(axis=1), 0.0)  # of one label alone nothing is fitted
    count = max(sum(seen.counts.values()), 1)
    mean = seen.sums / count
    spread = np.sqrt(np.maximum(seen.squares / count - mean**2, 0))
    scale = np.diag(np.where(spread > 1e-9 * (1 + np.abs(mean)), 1 / np.maximum(spread, 1e-300), 0.0))
    scale[:, -1] = -np.diag(scale) * mean
    scale[-1, -1] = 1.0
    points = np.zeros((n, width + 1))
    if totals.any():
        some = sampled(blocks, width, -(-count // SAMPLE))
        of_all = np.array([[w @ np.array([np.sum((some[1] == y) & (some[2] != k)) for y in (0, 1)])] for k, w in enumerate(weights)])[:, 0]
        points = descend(lambda at, open_: slopes(*some, at, weights, open_), points, np.where(totals > 0, of_all, 0.0), scale, START)
        del some
        zero = np.zeros((n, 1 + (width + 1) * (width + 2)))

        def evaluate(at: np.ndarray, open_: np.ndarray) -> np.ndarray:
            def total(rows: Iterable) -> np.ndarray:
                return sum((slopes(matrix(features, size, width), np.frombuffer(label), np.frombuffer(fold, np.int32), at, weights, open_) for label, fold, size, features in rows), zero)

            return reduced(blocks, ("label", "fold", "n", "features"), total, zero)

        points = descend(evaluate, points, totals, scale)
    for k in np.flatnonzero(totals == 0):
        points[k, -1] = 0.0 if not sizes[k].any() else np.inf if sizes[k, 1] else -np.inf
    return [(p[:-1], float(p[-1])) for p in points]


def model(rows: DataFrame, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """The fitted form that Spark ML saves, loads and applies."""
    context = rows.sparkSession.sparkContext
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(f"LogisticRegression_{uuid4().hex[-12:]}", _py2java(context, Vectors.dense(coefficients)), intercept)
    return LogisticRegressionModel(made)


def scores(blocks: DataFrame, fitted: list[tuple[np.ndarray, float]]) -> DataFrame:
    """(s1_id, target_id, label, fold, prob, holdout): each pair by the model that was fitted without its fold."""
    points = np.array([[*c, i] for c, i in fitted])
    width, last = points.shape[1] - 1, len(fitted) - 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, label, fold, n, features = (c[at].as_py() for c in batch.columns)
                known, fold = ids_of(ids), np.frombuffer(fold, np.int32)
                x, own = matrix(features, n, width), points[fold].T
                margin = (own[:-1] * x[:-1]).sum(axis=0) + own[-1]
                far = np.exp(-np.abs(margin))
                chance = np.where(margin >= 0, 1.0, far) / (1 + far)
                columns = [known.column("s1_id"), known.column("target_id"), np.frombuffer(label), fold, chance, fold == last]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["s1_id", "target_id", "label", "fold", "prob", "holdout"])

    return blocks.mapInArrow(score, SCORED)
