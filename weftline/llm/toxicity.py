"""Convolutional toxicity classifier in numpy, with thresholds calibrated by language.

A text's words (lower case, letters and digits only) become vectors: the embedding of the hashed word plus that
of its hashed first letters, so inflected forms share one. Filters of several widths run over the words, each is
max-pooled over the whole text, and a logistic layer turns the maxima into a calibrated probability. The network
is fitted on the driver from a bounded sample of labelled rows (see `labelled`); hashes that too few of its rows
have share one vector, so rare words can't be learned by heart, and vectors start from their hashes' log odds
between the sample's classes. For each language of the sample the threshold
with the best F1 on rows kept from fitting is found; it decides the column `flagged` and never the score.

Defined cases: a null text is empty; an empty text, or one without words, is one word without letters; without
labels of both classes every score is the smoothed share of label 1; an unknown or null language takes the
threshold over all languages; an empty table gives no rows; repeated
rows are scored each for itself; a very long text is scored whole, in slabs of a fixed size; of thresholds with equal F1
the highest is taken; further columns are not carried, whatever their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import labelled
from weftline.llm.common import let_go, map_batches

BUCKETS, EMBEDDED, WIDTHS, FILTERS = 1 << 15, 8, (1, 2, 3), 8
#: Letters that stand for a word's stem.
STEM = 4
#: Rows of the sample that have to share a hash for it to get a vector of its own.
LEAST_ROWS = 3
EPOCHS, BATCH, RATE = 20, 16, 0.05
#: Batches that a small sample is fitted with at least.
STEPS = 900
THRESHOLD = 0.3
#: Rows of a language that a threshold of its own takes.
LEAST_LANGUAGE = 60
#: Words that pass through the filters at a time.
SLAB = 1 << 15
REMEMBERED = 150_000


class Hashes(dict):
    """Word as it stands -> hash of its letters and digits, and of the first of them, in one number."""

    def __missing__(self, word: str) -> int:
        plain = "".join(filter(str.isalnum, word.lower()))
        both = 0
        if plain:
            both = (zlib.crc32(plain.encode("utf-8", "replace")) % (BUCKETS - 1) + 1) * BUCKETS
            both += zlib.crc32(b"\0" + plain[:STEM].encode("utf-8", "replace")) % (BUCKETS - 1) + 1
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = both
        return both


KNOWN = Hashes()


def hashed(text: str) -> tuple[np.ndarray, np.ndarray]:
    words = text.split() or [""]
    both = np.fromiter(map(KNOWN.__getitem__, words), dtype=np.int64, count=len(words))
    return both // BUCKETS, both % BUCKETS


@dataclass
class Model:
    words: np.ndarray  # (BUCKETS, EMBEDDED), rows of rare hashes all alike
    stems: np.ndarray
    filters: list[np.ndarray]  # for each width (width, EMBEDDED, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    offset: float
    slope: float = 1.0
    intercept: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, dtype=np.float32)
        for at in range(0, len(words), SLAB):
            x = self.words[words[at : at + SLAB + max(WIDTHS) - 1]] + self.stems[stems[at : at + SLAB + max(WIDTHS) - 1]]
            x = np.concatenate([x, np.zeros((max(WIDTHS) - 1, EMBEDDED), dtype=x.dtype)])
            n = min(SLAB, len(words) - at)
            for j, width in enumerate(WIDTHS):
                z = x[:n] @ self.filters[j][0]
                for k in range(1, width):
                    z += x[k : k + n] @ self.filters[j][k]
                own = best[j * FILTERS : (j + 1) * FILTERS]
                np.maximum(own, z.max(axis=0), out=own)
        return np.maximum(best + self.bias, 0)

    def logit(self, text: str) -> float:
        return float(self.pooled(*hashed(text)) @ self.out + self.offset)

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        return float(labelled.sigmoid(self.slope * self.logit(text) + self.intercept))


def shared(rows: list[np.ndarray]) -> np.ndarray:
    """For each hash its own number, or 0 where fewer than LEAST_ROWS rows have it."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        counts[np.unique(r)] += 1
    own = np.arange(BUCKETS)
    own[counts < LEAST_ROWS] = 0
    return own


def log_odds(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """For each hash the log odds ratio of its rows' labels in standard errors, a quarter of it, 1.5 at most."""
    counts = np.full((2, BUCKETS), 0.5)
    for r, label in zip(rows, y, strict=True):
        counts[int(label), np.unique(r)] += 1
    rest = np.array([[(y == 0).sum() + 1], [(y == 1).sum() + 1]]) - counts
    odds = np.log(counts / rest)
    return np.clip((odds[1] - odds[0]) / np.sqrt((1 / counts).sum(axis=0)) / 4, -1.5, 1.5).astype(np.float32)


def best_threshold(scores: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The score from which predicting 1 has the best F1, halfway to the next lower score; ties to the higher."""
    order = np.argsort(-scores, kind="stable")
    hit, all_ = np.cumsum((weights * y)[order]), np.cumsum(weights[order])
    f1 = 2 * hit / np.maximum(all_ + (weights * y).sum(), 1e-12)
    at = int(np.argmax(f1))
    ranked = scores[order]
    return float((ranked[at] + ranked[at + 1]) / 2 if at + 1 < len(ranked) else ranked[at])


def fit(texts: list[str], langs: list[str | None], y: np.ndarray, weights: np.ndarray, seed: int = 0) -> Model:
    """Adagrad over shuffled batches; every fifth row is kept for the calibration and the thresholds."""
    rng = np.random.default_rng(seed)
    words = rng.normal(0, 0.1, (BUCKETS, EMBEDDED)).astype(np.float32)
    stems = rng.normal(0, 0.1, (BUCKETS, EMBEDDED)).astype(np.float32)
    filters = [rng.normal(0, 0.5, (w, EMBEDDED, FILTERS)).astype(np.float32) for w in WIDTHS]
    n_out = len(WIDTHS) * FILTERS
    m = Model(words, stems, filters, np.zeros(n_out, np.float32), rng.normal(0, 0.3, n_out).astype(np.float32), 0.0)
    if len(y) < 10 or y.min() == y.max():
        m.constant = float((weights * y).sum() + 1) / float(weights.sum() + 2) if len(y) else 0.5
        return m
    rows = [hashed(t) for t in texts]
    own_words, own_stems = shared([r[0] for r in rows]), shared([r[1] for r in rows])
    rows = [(own_words[a], own_stems[b]) for a, b in rows]
    kept = np.arange(len(y)) % 5 == 0
    train = np.flatnonzero(~kept)
    words[:, 0], stems[:, 0] = (log_odds([rows[i][k] for i in train], y[train]) for k in (0, 1))
    for f in filters:  # half of the filters of each width start from the log odds alone
        f[:, :, : FILTERS // 2] *= 0.1
        f[0, 0, : FILTERS // 2] = 1.0
    m.out.reshape(len(WIDTHS), FILTERS)[:, : FILTERS // 2] = 0.5
    squares = {k: np.full_like(v, 1e-3) for k, v in (("words", words), ("stems", stems), ("bias", m.bias), ("out", m.out))}
    filter_squares = [np.full_like(f, 1e-3) for f in filters]
    offset_square = 1e-3
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(train)))):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            batch = train[at : at + BATCH]
            total = weights[batch].sum()
            g_bias, g_out, g_offset = np.zeros_like(m.bias), np.zeros_like(m.out), 0.0
            g_filters = [np.zeros_like(f) for f in filters]
            touched: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i in batch:
                a, b = rows[i]
                x = np.concatenate([words[a] + stems[b], np.zeros((max(WIDTHS) - 1, EMBEDDED), np.float32)])
                n, tops, places = len(a), [], []
                for j, width in enumerate(WIDTHS):
                    z = x[:n] @ filters[j][0]
                    for k in range(1, width):
                        z += x[k : k + n] @ filters[j][k]
                    place = z.argmax(axis=0)
                    places.append(place)
                    tops.append(z[place, np.arange(FILTERS)])
                raw = np.concatenate(tops) + m.bias
                act = np.maximum(raw, 0)
                error = weights[i] / total * (labelled.sigmoid(act @ m.out + m.offset) - y[i])
                g_out += error * act
                g_offset += error
                g = error * m.out * (raw > 0)
                g_bias += g
                for j, width in enumerate(WIDTHS):
                    own = g[j * FILTERS : (j + 1) * FILTERS]
                    for k in range(width):
                        p = places[j] + k
                        g_filters[j][k] += x[p].T * own
                        inside = p < n
                        touched.append((a[p[inside]], b[p[inside]], (filters[j][k] * own).T[inside]))
            for values, g, square in ((m.bias, g_bias, squares["bias"]), (m.out, g_out, squares["out"]), *zip(filters, g_filters, filter_squares, strict=True)):
                g = g + 1e-4 * values
                square += g * g
                values -= (RATE * g / np.sqrt(square)).astype(np.float32)
            offset_square += g_offset**2
            m.offset -= RATE * g_offset / np.sqrt(offset_square)
            step = np.concatenate([t[2] for t in touched])
            for values, square, at_ in ((words, squares["words"], 0), (stems, squares["stems"], 1)):
                ids, where = np.unique(np.concatenate([t[at_] for t in touched]), return_inverse=True)
                g = np.zeros((len(ids), EMBEDDED), np.float32)
                np.add.at(g, where, step)
                square[ids] += g * g
                values[ids] -= RATE * g / np.sqrt(square[ids])
    words[:], stems[:] = words[own_words], stems[own_stems]
    aside = np.flatnonzero(kept)
    m.slope, m.intercept = labelled.platt(np.array([m.logit(texts[i]) for i in aside]), y[aside], weights[aside])
    judged = np.array([m.score(texts[i]) for i in aside])
    m.thresholds[""] = best_threshold(judged, y[aside], weights[aside])
    for lang in sorted({langs[i] for i in aside if langs[i]}):
        own = np.array([langs[i] == lang for i in aside])
        if own.sum() >= LEAST_LANGUAGE and 0 < y[aside][own].sum() < own.sum():
            m.thresholds[lang] = best_threshold(judged[own], y[aside][own], weights[aside][own])
    return m


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows, y, weights = labelled.sample(docs, labels, "toxic")
    model = fit([r[1] for r in rows], [r[2] for r in rows], y, weights)
    del rows
    let_go()
    return model


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, flagged) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = model.value
        values = [m.score(t) for t in batch.column(2).to_pylist()]
        predicted = pa.array([int(v >= threshold) for v in values], pa.int32())
        cuts = m.thresholds
        flagged = [v >= cuts.get(lang or "", cuts.get("", threshold)) for v, lang in zip(values, batch.column(3).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.float64()), predicted, pa.array(flagged, pa.bool_())], names=["doc_id", "held_out", "score", "predicted", "flagged"])

    doc_id = F.col("doc_id").cast("bigint")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(doc_id.alias("doc_id"), labelled.held_out(doc_id).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"))
    return map_batches(rows, work, "doc_id bigint, held_out boolean, score double, predicted int, flagged boolean")
