"""Checks of result files: every rule is a relational check that yields rows of offenders.

A file is read as lines, (s1_id, ids) with the row's number; a finding is (severity, rule, file, n, examples).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXAMPLES = 5
#: The files' headers.
HEADERS = {"matching": ("source1_entity_id", "matched_entity_ids"), "candidate": ("source1_entity_id", "candidate_entity_ids")}
FINDING = "severity string, rule string, file string, n bigint, examples array<string>"


def rows_of(lines: DataFrame) -> DataFrame:
    """(no, s1_id, ids, has_tab) of each line after the header of (no, value); ids are not trimmed."""
    tab = F.instr("value", "\t")
    rest = F.when(tab > 0, F.substring("value", tab + 1, F.length("value"))).otherwise(F.lit(""))
    s1 = F.when(tab > 0, F.substring("value", F.lit(1), tab - 1)).otherwise(F.col("value"))
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return lines.select("no", "value", s1.alias("s1_id"), ids.alias("ids"), (tab > 0).alias("has_tab"))


def finding(offenders: DataFrame, rule: str, file: str, severity: str = "error") -> DataFrame:
    """One row, or none where there are no offenders; `offenders` is (id). Only the first ids reach one task."""
    ids = offenders.select(F.col("id").cast("string").alias("id")).distinct()
    shown = ids.orderBy("id").limit(EXAMPLES).agg(F.array_sort(F.collect_list("id")).alias("examples"))
    found = ids.agg(F.count(F.lit(1)).alias("n")).where("n > 0").join(shown)  # one row each
    return found.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), F.lit(file).alias("file"), "n", "examples")


def check_rows(rows: DataFrame, required: DataFrame, file: str, valid: DataFrame | None = None) -> DataFrame:
    """Findings of one file. `required` is (s1_id); `valid` is (target_id), or None to skip that check."""
    good = rows.where("has_tab")
    ids = good.select("s1_id", F.explode("ids").alias("id"))
    seen = good.select(F.col("s1_id").alias("id")).distinct()
    needed = required.select(F.col("s1_id").alias("id")).distinct()
    own, other = F.startswith("id", F.lit("S1-")), ~(F.startswith("id", F.lit("S2-")) | F.startswith("id", F.lit("S3-")))
    checks = [
        (rows.where(F.instr("value", "\ufffd") > 0).select(F.col("no").cast("string").alias("id")), "not_utf8"),
        (rows.where("not has_tab and trim(value) <> ''").select(F.concat_ws(": ", "no", "value").alias("id")), "malformed_row"),
        (good.groupBy(F.col("s1_id").alias("id")).count().where("count > 1"), "duplicate_row"),
        (good.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("s1_id").alias("id")), "repeated_id"),
        (ids.where(own).select("id"), "self_match"),
        (ids.where(~own & other).select("id"), "wrong_prefix"),
        (needed.join(seen, "id", "left_anti"), "missing_entity"),
        (seen.join(needed, "id", "left_anti"), "unknown_entity"),
    ]
    if valid is not None:
        known = valid.select(F.col("target_id").alias("id")).distinct()
        checks.append((ids.where(~own & ~other).select("id").distinct().join(known, "id", "left_anti"), "unknown_id"))
    return reduce(DataFrame.unionByName, (finding(df, rule, file) for df, rule in checks))


def last_rows(rows: DataFrame) -> DataFrame:
    """(s1_id, ids): of repeated rows the last counts."""
    return rows.where("has_tab").groupBy("s1_id").agg(F.max_by("ids", "no").alias("ids"))


def not_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """A warning where an entity's matches aren't all among its candidates."""
    pairs = last_rows(matched).join(last_rows(candidates).withColumnRenamed("ids", "known"), "s1_id", "left")
    outside: Column = F.size(F.array_except("ids", F.coalesce("known", F.array().cast("array<string>")))) > 0
    return finding(pairs.where(outside).select(F.col("s1_id").alias("id")), "match_not_candidate", "matching", "warning")


def row_counts(rows: DataFrame) -> DataFrame:
    """One row: rows, empty and non-empty lists."""
    good = rows.where("has_tab")
    return good.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size("ids") == 0).alias("n_empty"), F.count_if(F.size("ids") > 0).alias("n_filled"))


def report(spark: SparkSession, severity: str, rule: str, file: str, example: str = "") -> DataFrame:
    return spark.createDataFrame([(severity, rule, file, 1, [example] if example else [])], FINDING)


def check_file(spark: SparkSession, path: str, kind: str, required: DataFrame, valid: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(findings, rows) of a file; no rows where its header rules out reading on."""
    from weftline.sources.tsv import exists, numbered_lines

    if not exists(spark, path):
        return report(spark, "error", "file_not_found", kind, path), None
    lines = numbered_lines(spark, path)
    head = lines.orderBy("no").limit(1).collect()
    if not head:
        return report(spark, "error", "file_empty", kind, path), None
    if "\t" not in head[0].value and "," in head[0].value:
        return report(spark, "error", "comma_header", kind, head[0].value), None
    if [c.strip().lower() for c in head[0].value.split("\t")] != list(HEADERS[kind]):
        return report(spark, "error", "wrong_header", kind, head[0].value), None
    rows = rows_of(lines.where(F.col("no") > head[0].no))
    return check_rows(rows, required, kind, valid), rows


def validate(spark: SparkSession, matching: str, candidate: str | None, test_dir: str, check_ids: bool = False) -> DataFrame:
    """Findings on result files; errors fail a submission and warnings don't."""
    from weftline.sources.tsv import exists, load_tsv

    if not exists(spark, f"{test_dir}/test_source1.tsv"):
        return report(spark, "error", "source1_not_found", "test_source1", test_dir)
    required = load_tsv(spark, f"{test_dir}/test_source1.tsv").select(F.trim("entity_id").alias("s1_id"))
    found, valid = [], None
    if check_ids:
        paths = [f"{test_dir}/test_source{k}.tsv" for k in (2, 3)]
        if all(exists(spark, p) for p in paths):
            valid = reduce(DataFrame.unionByName, (load_tsv(spark, p).select(F.trim("entity_id").alias("target_id")) for p in paths))
        else:
            found.append(report(spark, "warning", "targets_not_found", "test_source2/3", test_dir))
    else:
        found.append(report(spark, "warning", "id_check_off", "matching"))
    findings, matched = check_file(spark, matching, "matching", required, valid)
    found.append(findings)
    if candidate and exists(spark, candidate):
        findings, pairs = check_file(spark, candidate, "candidate", required, valid)
        found.append(findings)
        if matched is not None and pairs is not None:
            found.append(not_candidates(matched, pairs))
    elif candidate:
        found.append(report(spark, "warning", "candidates_not_found", "candidate", candidate))
    return reduce(DataFrame.unionByName, found)
