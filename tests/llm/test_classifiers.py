from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from weftline.llm import labelled, quality, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


def text_of(k: int) -> tuple[str, int, int]:
    """(text, quality, toxic) of a made-up document: noise after every word is bad, some words are toxic."""
    rng = random.Random(k)
    words = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}" for _ in range(rng.randrange(30, 150))]
    good, toxic = int(k % 3 > 0), int(k % 4 == 0)
    if toxic:
        for _ in range(3):
            words.insert(rng.randrange(len(words)), rng.choice(["zounder", "zoundish", "quxling"]))
    if not good:
        words = [w + rng.choice(["%%%", "&&&", "###"]) for w in words]
    return " ".join(words), good, toxic


@pytest.fixture(scope="module")
def tables(spark, documents):
    rows = [text_of(k) for k in range(400)]
    labels = spark.createDataFrame([(k, r[1], r[2]) for k, r in enumerate(rows)] + [(None, 1, 1), (3, None, None), (9999, 0, 0)], LABELS)
    return documents([r[0] for r in rows], extra=True), labels, rows


@pytest.mark.parametrize(("module", "name", "at"), [(quality, "quality", 1), (toxicity, "toxic", 2)])
def test_held_out_rows(tables, module, name, at):
    docs, labels, rows = tables
    found = {r.doc_id: r for r in module.scores(docs, labels).collect()}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in found.items())
    aside = [k for k, r in found.items() if r.held_out]
    assert np.mean([found[k].predicted == rows[k][at] for k in aside]) > 0.95


def test_labels_of_held_out_rows_and_other_columns_are_not_used(spark, tables):
    from pyspark.sql import functions as F

    docs, labels, _ = tables
    flipped = labels.withColumn("quality", F.when(labelled.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).repartition(5)
    one, two = (sorted((r.doc_id, r.score) for r in quality.scores(d, x).collect()) for d, x in ((docs, labels), (other, flipped)))
    assert one == two


def test_odd_texts(spark, tables, documents):
    _, labels, _ = tables
    docs, _, rows = tables
    long = rows[1][0] + " " + " ".join(r[0] for r in rows if r[1] and not r[2])[:200_000]
    odd = documents([(10_000, None), (10_001, ""), (10_002, "é"), (10_003, long), (10_003, long), (None, "x")], extra=True)
    for module in (quality, toxicity):
        found = module.scores(docs.unionByName(odd), labels).where("doc_id >= 10000 or doc_id is null").collect()
        assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id == 10_003}) == 1 and len({r.score for r in found if r.doc_id in (10_000, 10_001)}) == 1


def test_without_labels(spark, tables):
    docs, labels, _ = tables
    for module in (quality, toxicity):
        assert {r.score for r in module.scores(docs, labels.limit(0)).select("score").distinct().collect()} == {0.5}
        assert module.scores(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.where("quality = 1")).count() == docs.count()


def test_filter_keeps_columns_and_good_rows(tables):
    docs, labels, rows = tables
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert np.mean([(k in ids) == bool(r[1]) for k, r in enumerate(rows)]) > 0.95


def test_long_texts_are_scored_whole():
    """Pieces of a long text give what one pass over it gives."""
    rng = np.random.default_rng(0)
    model = quality.fit([], np.empty(0), np.empty(0))
    text = bytes(rng.integers(32, 127, 3 * quality.SLAB + 77, dtype=np.uint8))
    flat = np.frombuffer(text, dtype=np.uint8)
    n = len(flat) - quality.WIDTH + 1
    z = sum(model.tables[k][flat[k : k + n]] for k in range(quality.WIDTH))
    want = np.stack([z[at : at + quality.HALF].max(axis=0) for at in range(0, n, quality.HALF)])
    assert np.allclose(model.halves(text)[: len(want)], want, atol=1e-5)
    words = " ".join(f"w{k % 977}" for k in range(2 * toxicity.SLAB + 5))
    model = toxicity.fit([], [], np.empty(0), np.empty(0))
    whole, toxicity.SLAB = toxicity.SLAB, 1 << 20
    once = model.logit(words)
    toxicity.SLAB = whole
    assert model.logit(words) == pytest.approx(once, abs=1e-5)


def test_thresholds_by_language():
    scores, y, weights = np.array([0.9, 0.8, 0.3, 0.2]), np.array([1.0, 1.0, 0.0, 0.0]), np.ones(4)
    assert toxicity.best_threshold(scores, y, weights) == pytest.approx(0.55)
    slope, intercept = labelled.platt(np.array([-2.0, -1.0, 1.0, 2.0]), np.array([0.0, 0.0, 1.0, 1.0]), weights)
    assert slope > 0 and abs(intercept) < 0.1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_the_driver_gives_back_its_sample(monkeypatch, module):
    asked = []
    monkeypatch.setattr(module.labelled, "sample", lambda *tables: ([(1, "one", "en"), (2, "two", "en")], np.array([0.0, 1.0]), np.ones(2)))
    monkeypatch.setattr(module, "let_go", lambda: asked.append(1))
    assert module.train(None, None) is not None and asked
