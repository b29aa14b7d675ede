from __future__ import annotations

import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from weftline.llm import packing, queries

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def folder(spark, documents, prose_of, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    texts = [prose_of(k, 60 + k % 50) for k in range(150)]
    texts += [" ".join(w + "%%%" for w in prose_of(900 + k, 80).split()) for k in range(60)]  # 150 to 209: bad
    texts += [texts[k] + " tail" for k in range(20)]  # 210 to 229: near copies of 0 to 19
    item = prose_of(4000, 40)
    texts += [prose_of(5000, 60) + " " + item + " " + prose_of(5001, 60), prose_of(5002, 90) + " password=abcdefgh123 " + prose_of(5003, 30)]
    docs = documents(texts)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(not 150 <= k < 210), 0) for k in range(230)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), texts


def test_stages(spark, folder, tmp_path):
    path, texts = folder
    rows = spark.read.parquet(f"{path}/documents.parquet")
    columns, ids = rows.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, path)
        if name != "best_fit_packing":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        rows = spark.read.parquet(str(tmp_path / str(k)))
        ids[name] = {r.doc_id for r in rows.select("doc_id").collect()}
    good = set(range(len(texts))) - set(range(150, 210))
    assert len(ids["quality_classifier"] ^ good) <= 3
    left = ids["quality_classifier"]
    want = {i for i in left if not (210 <= i < 230 and i - 210 in left)}
    assert ids["ngram_jaccard_join"] == want
    assert ids["benchmark_decontamination"] == want - {230}
    assert ids["secret_scan"] == ids["best_fit_packing"] == want - {230}
    secret = spark.read.parquet(str(tmp_path / "3")).where("doc_id = 231").first()
    assert "[secret]" in secret.text and "abcdefgh123" not in secret.text and secret.n_chars == len(secret.text)
    packed, run = (defaultdict(int), defaultdict(int))
    for r in rows.collect():
        packed[r.doc_id, r.piece] = r.ids_crc32
    result = corpus_pipeline.run(spark, path).collect()
    for r in result:
        run[r.doc_id, r.piece] = r.ids_crc32
    assert run == packed and all(r.offset + r.length <= packing.CAPACITY for r in result)


def test_stages_on_empty_and_unlabelled_tables(spark, folder, tmp_path):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.quality_classifier(spark, docs, str(tmp_path)).count() == len(texts)


def test_registered_queries():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 11)]
    assert set(queries.oracle_sql()) <= set(names)


def test_the_rest_stands_alone(tmp_path):
    """Without the subpackage and the pipeline the entry module still imports and has its other queries."""
    code = "import sys; sys.modules['weftline.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), any(k.startswith('op') for k in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) > 40 and said[1:] == ["False", "False"]
