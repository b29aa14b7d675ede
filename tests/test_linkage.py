from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from weftline import queries
from weftline.operators import blocking, features, logistic, metrics, profiling, threshold, validation
from weftline.operators.models import EntityClassifier, balanced_folds
from weftline.plans.linker import Linker
from weftline.sources import tsv
from weftline.sources.samples import TRUTH, generate

@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("sources")
    generate(str(path))
    for k in (1, 2, 3):  # here both splits have the records whose links are known
        (path / f"test_source{k}.tsv").write_text((path / f"train_source{k}.tsv").read_text())
    return path


@pytest.fixture(scope="module")
def loaded(spark, folder):
    records, truth = tsv.load_split(spark, str(folder), "train")
    return records.cache(), *tsv.links(truth)


def test_load(spark, folder, loaded, tmp_path):
    records, entities, links = loaded
    assert records.count() == 9 and entities.count() == 4 and links.count() == 4
    first = tsv.load_tsv(spark, str(folder / "train_source1.tsv"), rows=2).collect()
    assert [r.entity_id for r in first] == ["S1-00001", "S1-00002"]
    with pytest.raises(FileNotFoundError):
        tsv.load_tsv(spark, str(folder / "none.tsv"))
    odd = tmp_path / "odd.tsv"
    odd.write_text('entity_id\tbusiness_name\tcountry\nS2-1\t"a ""b"" c"\nS2-2\tNA\tNone\n')
    rows = tsv.load_tsv(spark, str(odd)).orderBy("no").collect()
    assert [(r.business_name, r.business_address, r.country) for r in rows] == [('a "b" c', "", ""), ("NA", "", "None")]
    cached = tsv.load_source(spark, str(odd), 2, cache=str(tmp_path / "cache"))
    assert cached.count() == 2 and (tmp_path / "cache" / "_SUCCESS").exists()


def votes_by_hand(records) -> dict[str, list[str]]:
    """A sequential count of some channels: dictionaries filled in source order, counters, most_common."""
    rows = sorted(records.collect(), key=lambda r: r.ord)
    out = {}
    for country in {r.norm_country for r in rows}:
        index = defaultdict(list)
        for r in rows:
            if r.norm_country == country and r.src > 1 and r.norm_name:
                index["name", r.norm_name].append(r.entity_id)
                for w in r.norm_name.split():
                    index["token", w].append(r.entity_id)
        for r in rows:
            if r.norm_country == country and r.src == 1:
                count = Counter()
                for t in index["name", r.norm_name][:30]:
                    count[t] += 8
                for w in r.norm_name.split():
                    for t in index["token", w][:8]:
                        count[t] += 1
                out[r.entity_id] = [t for t, _ in count.most_common(3)]
    return out


def test_ranked_ties_follow_the_first_touch(spark):
    names = ["oak elm", "elm oak", "oak oak", "fir elm", "oak fir elm", "elm"]
    rows = [(f"S{s}-{k:03}", s, (s << 56) + k, names[(k * 7 + s) % 6], "", "us") for s in (1, 2, 3) for k in range(40)]
    records = spark.createDataFrame(rows, "entity_id string, src int, ord bigint, norm_name string, norm_address string, norm_country string")
    order = blocking.Window.partitionBy("s1_id").orderBy(F.desc("votes"), "first_touch")
    cast = blocking.hits(records, only=(1, 8))
    found = blocking.votes(cast).withColumn("rank", F.row_number().over(order)).where("rank <= 3")
    lists = blocking.nested(found, records.where("src = 1")).collect()
    assert {r.s1_id: r.candidate_ids for r in lists} == votes_by_hand(records)


def test_candidates(loaded):
    records, entities, links = loaded
    found = blocking.candidates(records).cache()
    quality = metrics.evaluate_blocking(found, links, 4, 5).first()
    assert quality.blocking_recall == 1.0 and quality.captured_links == 4
    assert blocking.candidates(records, blocking.BlockingConfig(max_total_candidates=1)).groupBy("s1_id").count().agg(F.max("count")).first()[0] == 1
    chunked = blocking.candidates(records, blocking.BlockingConfig(chunk_size=2))
    assert {(r.s1_id, r.target_id) for r in chunked.collect()} >= {(r.s1_id, r.target_id) for r in found.collect()}
    assert blocking.nested(found, records.where("src = 1")).count() == 4


def test_blocking_quality_of_many_records(spark):
    found = spark.createDataFrame([("a", "x"), ("a", "y")], "s1_id string, target_id string")
    links = found.where("target_id = 'x'")
    for n_s1, n_target in ((40_000, 80_000), (4_000_000_000, 8_000_000_000)):
        quality = metrics.evaluate_blocking(found, links, n_s1, n_target).first()
        assert quality.reduction_ratio == 1 - 2 / (n_s1 * n_target) and quality.avg_candidates_per_s1 == 2 / n_s1


def test_features(loaded):
    records, _, links = loaded
    rows = {(r.s1_id, r.target_id): r for r in features.pair_features(links, records).collect()}
    r = rows["S1-00001", "S3-00100"]
    assert len(features.FEATURE_COLUMNS) == 49 and r.name_exact == r.name_ratio == r.name_jw == 1.0 and r.is_source3 == 1.0 and r.country_id == 0.0
    assert r.geo_overlap_count == 1.0 and r.contradictory_geo == 0.0 and r.addr_first_num_match == 0.0
    assert all(0 <= r[c] <= 1 for r in rows.values() for c in features.FEATURE_COLUMNS if not c.endswith(("count", "diff", "id")))


def test_scores(spark):
    entities = spark.createDataFrame([("a",), ("b",), ("c",)], "s1_id string")
    links = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "s1_id string, target_id string")
    said = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "q"), ("zz", "x")], "s1_id string, target_id string")
    scores = {r.s1_id: r.f05 for r in metrics.entity_f05(said, entities, links).collect()}
    assert scores == {"a": pytest.approx(0.714286, abs=1e-6), "b": 0.0, "c": 1.0}
    total = metrics.evaluate_predictions(said, entities, links).first()
    assert (total.singleton_count, total.singleton_accuracy, total.total_false_positives, total.total_predictions) == (1, 1.0, 1, 3)
    assert metrics.evaluate_predictions(links, entities, links).first().macro_f05 == 1.0
    assert metrics.evaluate_predictions(said, entities.limit(0), links).first().macro_f05 == 0.0


def test_thresholds(spark):
    entities = spark.createDataFrame([("a",), ("b",)], "s1_id string")
    links = spark.createDataFrame([("a", "x")], "s1_id string, target_id string")
    scored = spark.createDataFrame([("a", "x", 0.8), ("a", "y", 0.4), ("b", "x", 0.4), ("a", "x", 0.3)], "s1_id string, target_id string, prob double")
    best, score, _ = threshold.optimize_f05_threshold(scored, entities, links)
    assert score == 1.0 and 0.4 < best <= 0.42
    by_hand = {p: metrics.evaluate_predictions(scored.where(F.col("prob") >= p), entities, links).first().macro_f05 for p in (0.3, 0.4, 0.7, 0.9)}
    assert {r.threshold: r.macro_f05 for r in threshold.threshold_sweep(scored, entities, links, list(by_hand)).collect()} == pytest.approx(by_hand)
    lists = {r.s1_id: r.matched_ids for r in threshold.apply_threshold(scored, entities, 0.4, most=1).collect()}
    assert lists == {"a": ["x"], "b": ["x"]}
    assert threshold.optimize_f05_threshold(scored.limit(0), entities.limit(0), links)[0] == 0.5


def test_profiles(loaded):
    records, _, links = loaded
    found = profiling.analyze(records, links)
    assert {r.n_matches: r.entities for r in found["match_histogram"].collect()} == {0: 1, 1: 2, 2: 1}
    assert found["name_overlap"].first().in_either == 1
    assert found["link_summary"].first().singleton_rate == 0.25
    assert all(f.limit(1).count() for f in found.values())
    assert profiling.analyze(records.limit(0), links.limit(0))["link_summary"].first().singleton_rate == 0.0


def test_models_and_inference(spark, tmp_path):
    n = 60
    names = [f"{a} {b}" for a in ("oak", "elm", "fir", "ash", "yew", "bay") for b in ("works", "tools", "foods", "labs", "press", "mills", "farms", "books", "glass", "paper")]
    rows = []
    for k in range(n):
        rows.append((f"S1-{k:04}", 1, (1 << 56) + k, names[k], f"{k + 10} hill way {56000 + k}", "us"))
        rows.append((f"S2-{k:04}", 2, (2 << 56) + k, names[k] + (" east" if k % 3 else ""), f"{k + 10} hill way" if k % 2 else "", "us"))
    schema = "entity_id string, src int, ord bigint, norm_name string, norm_address string, norm_country string"
    records = spark.createDataFrame(rows, schema).withColumn("business_address", F.col("norm_address")).cache()
    entities = records.where("src = 1").select(F.col("entity_id").alias("s1_id"))
    links = entities.select("s1_id", F.replace("s1_id", F.lit("S1"), F.lit("S2")).alias("target_id"))
    linker = Linker(model_type="logistic_regression")
    report = linker.fit(records, entities, links, str(tmp_path / "train"))
    assert report["blocking_recall"] == 1.0 and report["scored_macro_f05"] > 0.8
    linker.classifier.save(str(tmp_path / "model"))
    again = EntityClassifier.load(str(tmp_path / "model"))
    pairs = spark.read.parquet(str(tmp_path / "train/pairs"))
    one, two = (c.predict_proba(pairs).orderBy("s1_id", "target_id").select("prob").collect() for c in (linker.classifier, again))
    assert one == two
    results = linker.infer(records, str(tmp_path / "runs")).collect()
    assert len(results) == n and all(set(r.matched_ids) <= set(r.candidate_ids) for r in results)
    assert linker.infer(records, str(tmp_path / "runs")).count() == n
    folds = balanced_folds(pairs, 3).groupBy("fold").count().count()
    assert folds == 3
    with pytest.raises(RuntimeError):
        EntityClassifier().predict_proba(pairs)


def test_folds_are_dealt_before_there_are_features(spark):
    scored = queries.model_scores(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()  # no fold moves features
    pairs = queries.block_topk(spark, "/root/testdata/sf0.001").select("s1_id", "target_id").cache()
    folds = {r.s1_id: r.fold for r in balanced_folds(pairs, 5).collect()}
    rows = scored.collect()
    assert sorted((r.s1_id, r.target_id) for r in rows) == sorted(map(tuple, pairs.collect()))
    assert all(r.fold == folds[r.s1_id] and r.holdout == (r.fold == 4) for r in rows) and set(folds.values()) == set(range(5))


def test_all_folds_are_fitted_in_the_same_passes(spark):
    context = spark.sparkContext
    context.setJobGroup("model_scores", "all folds")
    rows = queries.model_scores(spark, "/root/testdata/sf0.001").collect()
    jobs = len(context.statusTracker().getJobIdsForGroup("model_scores"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 120  # 300 and more where each fold has its own steps
    assert rows and all(0 <= r.prob <= 1 for r in rows)


def test_logistic_regression_reaches_the_least_loss(spark):
    draw = np.random.default_rng(3)
    x, truth = draw.normal(size=(3, 1200)) * [[1.0], [10.0], [0.1]], np.array([1.0, -0.1, 5.0])
    label = (draw.random(1200) < 1 / (1 + np.exp(1 - truth @ x))).astype(float)
    x = np.stack([*x, x[0] - x[1], np.full(1200, 7.0)])  # one that depends on others, one that doesn't vary
    names = [f"x{k}" for k in range(5)]
    rows = spark.createDataFrame([(f"a{k % 40}", f"b{k}", float(label[k]), k % 40 % 3, *map(float, x[:, k])) for k in range(1200)], "s1_id string, target_id string, label double, fold int, " + ", ".join(f"{c} double" for c in names)).repartition(3)
    blocks = logistic.packed(rows, names)
    seen = logistic.look(blocks, 5, 5)
    assert len(seen.entities) >= 5 and sum(seen.counts.values()) == 1200
    fitted = logistic.fit(blocks, 5, seen, 3, EntityClassifier.balanced)
    found = {r.target_id: r for r in logistic.scores(blocks, fitted).collect()}
    assert len(found) == 1200 and all(r.holdout == (r.fold == 2) and r.label == label[int(k[1:])] for k, r in found.items())
    frame = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    for k in range(3):
        one = float(label[np.arange(1200) % 40 % 3 != k].mean())
        part = frame.where(F.col("fold") != k).withColumn("weight", F.when(F.col("label") == 1, 0.5 / one).otherwise(0.5 / (1 - one)))
        theirs = LogisticRegression(maxIter=500, tol=1e-12, weightCol="weight").fit(part)
        own = logistic.model(rows, *fitted[k])
        for m in (theirs, own):
            probs = {r.target_id: r.probability[1] for r in m.transform(frame.where(F.col("fold") == k)).collect()}
            assert probs == pytest.approx({t: r.prob for t, r in found.items() if r.fold == k}, abs=1e-4)


def test_logistic_regression_of_one_label(spark):
    rows = spark.createDataFrame([(f"a{k}", f"b{k}", 0.0, k % 2, float(k)) for k in range(6)], "s1_id string, target_id string, label double, fold int, x double")
    for kept, label, prob in ((rows, 0.0, 0.0), (rows.withColumn("label", F.lit(1.0)), 1.0, 1.0)):
        blocks = logistic.packed(kept, ["x"])
        fitted = logistic.fit(blocks, 1, logistic.look(blocks, 1, 5), 2, EntityClassifier.balanced)
        assert {(r.label, r.prob) for r in logistic.scores(blocks, fitted).collect()} == {(label, prob)}
    none = logistic.packed(rows.limit(0), ["x"])
    assert logistic.scores(none, logistic.fit(none, 1, logistic.look(none, 1, 5), 2, EntityClassifier.balanced)).count() == 0


def test_validation(spark, folder, tmp_path):
    good = [f"{k}\t{','.join(v)}" for k, v in TRUTH.items()]

    def findings(lines, header="source1_entity_id\tmatched_entity_ids", candidate=None, check_ids=True):
        path = tmp_path / "matching.tsv"
        path.write_text("\n".join([header, *lines]) + "\n")
        return {r.rule: r for r in validation.validate(spark, str(path), candidate, str(folder), check_ids).collect()}

    assert findings(good) == {}
    assert findings(good, header="a,b").keys() == {"comma_header"}
    assert findings(good, header="a\tb").keys() == {"wrong_header"}
    bad = findings([*good[:2], good[1], "S1-9\tS1-1,S9-1,S2-none", "no tab", "S1-00003\tS2-00010,S2-00010"])
    assert bad.keys() == {"duplicate_row", "unknown_entity", "self_match", "wrong_prefix", "unknown_id", "malformed_row", "repeated_id", "missing_entity"}
    assert bad["missing_entity"].examples == ["S1-00004"] and bad["unknown_id"].n == 1
    pairs = tmp_path / "pairs.tsv"
    pairs.write_text("\n".join(["source1_entity_id\tcandidate_entity_ids", "S1-00001\tS2-00010", *good[1:]]) + "\n")
    warned = findings(good, candidate=str(pairs), check_ids=False)
    assert {k: v.severity for k, v in warned.items()} == {"match_not_candidate": "warning", "id_check_off": "warning"}


def test_export(spark, loaded, tmp_path):
    lists = spark.createDataFrame([("S1-2", []), ("S1-1", ["S2-1", "S3-1"])], "s1_id string, ids array<string>")
    tsv.export_tsv(lists, str(tmp_path / "out"), "matched_entity_ids", "ids")
    assert (tmp_path / "out").read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
    assert tsv.package(str(tmp_path), ["nothing"], str(tmp_path / "a.zip")) == ["nothing"]


def test_stream(spark, loaded, tmp_path):
    from weftline.streaming.incremental import link_stream

    records, _, _ = loaded
    records.where("src = 1").drop("src").write.parquet(str(tmp_path / "in"))
    queries = spark.readStream.schema(records.drop("src").schema).parquet(str(tmp_path / "in"))
    link_stream(queries, records.where("src <> 1"), str(tmp_path / "out")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out/candidates")).select("s1_id", "target_id", "votes", "rank")
    assert sorted(found.collect()) == sorted(blocking.candidates(records).collect())


def test_command_line(spark, folder, tmp_path, capsys, monkeypatch):
    from weftline.plans import cli

    monkeypatch.chdir(tmp_path)
    common = ["--train-dir", str(folder), "--test-dir", str(folder), "--out", str(tmp_path / "out")]
    assert cli.main(["--mode", "eda", *common]) == 0 and cli.main(["--mode", "blocking", *common]) == 0
    assert cli.main(["--mode", "test", *common]) == 1
    assert cli.main(["--mode", "full", "--model", "logistic_regression", *common]) == 0
    assert "4 rows" in capsys.readouterr().out
    assert cli.main(["--mode", "test", "--test-sample", "2", *common]) == 0
    assert cli.main(["--mode", "package", *common]) == 0 and (tmp_path / "team.zip").exists()


def test_chunks_number_each_source_in_its_own_ranges(spark):
    """Two sources whose orders lie far apart: chunks follow the order, and ranges are as fine in both."""
    rows = [(f"S{src}-{k}", "india" if k % 3 else "us", (src << tsv.SOURCE_BIT) + k) for src in (2, 3) for k in range(300)]
    targets = spark.createDataFrame(rows, "entity_id string, norm_country string, ord bigint")
    found = blocking.chunked(targets, 7).orderBy("norm_country", "ord").collect()
    for country in ("india", "us"):
        assert [r.chunk for r in found if r.norm_country == country] == [k // 7 for k in range(sum(r[1] == country for r in rows))]


def test_archive_holds_the_files(spark, tmp_path):
    import zipfile

    lists = spark.createDataFrame([(f"S1-{k:03d}", [f"S2-{k}"] * (k % 3)) for k in range(50)], "s1_id string, ids array<string>").repartition(5)
    tsv.export_tsv(lists, str(tmp_path / "r.tsv"), "matched_entity_ids", "ids")
    lines = (tmp_path / "r.tsv").read_text().splitlines()
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and lines[1:] == [f"S1-{k:03d}\t" + ",".join([f"S2-{k}"] * (k % 3)) for k in range(50)]
    (tmp_path / "folder").mkdir()
    assert tsv.package(str(tmp_path), ["r.tsv", "folder"], str(tmp_path / "a.zip")) == ["folder"]
    with zipfile.ZipFile(tmp_path / "a.zip") as bundle:
        assert bundle.read("r.tsv") == (tmp_path / "r.tsv").read_bytes()


def test_sources_keep_other_scripts(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tचाय घर\tदिल्ली 12\tIndia\n", encoding="utf-8")
    row = tsv.load_source(spark, str(tmp_path / "s.tsv"), 1).first()
    assert row.norm_name.isascii() and row.norm_name.strip() and row.norm_address.replace("12", "").strip().isascii() and len(row.norm_address) > 4


def test_other_records_resume_nothing(spark, tmp_path):
    from weftline.plans.linker import Linker

    generate(str(tmp_path))
    train, _ = tsv.load_split(spark, str(tmp_path), "train")
    test, _ = tsv.load_split(spark, str(tmp_path), "test")
    linker = Linker()
    assert linker.fingerprint(train) == linker.fingerprint(train) != linker.fingerprint(test)
    assert {r.norm_country for r in test.select("norm_country").distinct().collect()} - {r.norm_country for r in train.select("norm_country").distinct().collect()}
