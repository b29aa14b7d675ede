"""Command line: profile, block, train and infer, infer only, package, validate."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import metrics, profiling, validation
from weftline.operators.models import MODEL_TYPES, EntityClassifier
from weftline.plans.linker import THRESHOLD, Linker, coverage, stored
from weftline.sources import tsv

FILES = ("matching_results.tsv", "candidate_pairs.tsv")


def session() -> SparkSession:
    return SparkSession.builder.appName("weftline").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def load(spark: SparkSession, folder: str, prefix: str, sample: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    records, truth = tsv.load_split(spark, folder, prefix, sample)
    if truth is None:
        truth = records.where("src = 1").select(F.col("entity_id").alias("s1_id"), F.array().cast("array<string>").alias("matched_ids"))
    return stored(records), *tsv.links(stored(truth))


def export(results: DataFrame, out: str) -> None:
    tsv.export_tsv(results, f"{out}/{FILES[0]}", "matched_entity_ids", "matched_ids")
    tsv.export_tsv(results, f"{out}/{FILES[1]}", "candidate_entity_ids", "candidate_ids")


def check(spark: SparkSession, matching: str, candidate: str | None, test_dir: str, check_ids: bool) -> int:
    findings = validation.validate(spark, matching, candidate, test_dir, check_ids).collect()
    for path in (matching, candidate):
        if path and tsv.exists(spark, path):
            lines = tsv.numbered_lines(spark, path)
            n = validation.row_counts(validation.rows_of(lines.where(lines.no > 0))).first()
            print(f"{path}: {n.n_rows} rows ({n.n_empty} empty, {n.n_filled} non-empty)")
    for f in findings:
        print(f"{f.severity.upper()} {f.file} {f.rule}: {f.n}, e.g. {', '.join(f.examples)}")
    return int(any(f.severity == "error" for f in findings))


def infer(spark: SparkSession, linker: Linker, args: argparse.Namespace) -> int:
    records, _, _ = load(spark, args.test_dir, "test", args.test_sample)
    results = linker.infer(records, f"{args.out}/checkpoints")
    everyone = tsv.load_source(spark, f"{args.test_dir}/test_source1.tsv", 1).select(F.col("entity_id").alias("s1_id"))
    none = F.array().cast("array<string>")
    results = everyone.join(results, "s1_id", "left").select("s1_id", *(F.coalesce(c, none).alias(c) for c in ("candidate_ids", "matched_ids")))
    export(results, args.out)
    coverage(results).show()
    return check(spark, f"{args.out}/{FILES[0]}", f"{args.out}/{FILES[1]}", args.test_dir, False)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="weftline")
    parser.add_argument("--mode", choices=("eda", "blocking", "test", "full", "package", "validate"), default="full")
    parser.add_argument("--train-dir", default="data/train")
    parser.add_argument("--test-dir", "-t", default="data/test")
    parser.add_argument("--model", choices=MODEL_TYPES, default="ensemble")
    parser.add_argument("--team-name", default="team")
    parser.add_argument("--threshold", type=float, default=THRESHOLD)
    parser.add_argument("--sample", type=int)
    parser.add_argument("--test-sample", type=int)
    parser.add_argument("--out", default="output")
    parser.add_argument("--matching", "-m", default=f"output/{FILES[0]}")
    parser.add_argument("--candidate", "-c", default=None)
    parser.add_argument("--check-ids", action="store_true")
    args = parser.parse_args(argv)
    if args.mode == "package":
        for name in tsv.package(args.out, list(FILES), f"{args.team_name}.zip"):
            print(f"missing: {name}", file=sys.stderr)
        return 0
    spark = session()
    if args.mode == "validate":
        return check(spark, args.matching, args.candidate or f"{args.out}/{FILES[1]}", args.test_dir, args.check_ids)
    linker = Linker(model_type=args.model, threshold=args.threshold)
    if args.mode == "test":
        if not tsv.exists(spark, f"{args.out}/model/about"):
            print("no trained model; run --mode full first", file=sys.stderr)
            return 1
        linker.classifier = EntityClassifier.load(f"{args.out}/model")
        return infer(spark, linker, args)
    records, entities, links = load(spark, args.train_dir, "train", args.sample)
    if args.mode == "eda":
        for name, frame in profiling.analyze(records, links).items():
            print(name)
            frame.show(50, truncate=False)
        return 0
    if args.mode == "blocking":
        n_s1, n_target = records.agg(F.count_if(F.col("src") == 1), F.count_if(F.col("src") != 1)).first()
        metrics.evaluate_blocking(linker.candidates(records), links, n_s1, n_target).show(truncate=False)
        return 0
    for k, v in linker.fit(records, entities, links, f"{args.out}/train").items():
        print(f"{k}: {v}")
    linker.classifier.save(f"{args.out}/model")
    return infer(spark, linker, args)


if __name__ == "__main__":
    sys.exit(main())
