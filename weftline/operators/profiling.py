"""Profiles of sources and of known links, as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = {"name": "business_name", "address": "business_address", "country": "country"}


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / F.greatest(whole, F.lit(1))).otherwise(F.lit(0.0))


def words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))


def missing_fields(records: DataFrame) -> DataFrame:
    """(src, total_rows, missing_* and their percentages): fields that are null or only white space."""
    blank = {k: F.count_if(F.trim(F.coalesce(F.col(c), F.lit(""))) == "") for k, c in FIELDS.items()}
    total = F.count(F.lit(1))
    return records.groupBy("src").agg(total.alias("total_rows"), *(v.alias(f"missing_{k}") for k, v in blank.items()), *(percent(v, total).alias(f"missing_{k}_pct") for k, v in blank.items()))


def field_lengths(records: DataFrame) -> DataFrame:
    """(src, mean, least and largest length in characters and words of name and address)."""
    columns = []
    for k in ("name", "address"):
        text = F.coalesce(F.col(FIELDS[k]), F.lit(""))
        for kind, size in (("chars", F.length(text)), ("words", words(text))):
            columns += [F.avg(size).alias(f"{k}_{kind}_mean"), F.min(size).cast("bigint").alias(f"{k}_{kind}_min"), F.max(size).cast("bigint").alias(f"{k}_{kind}_max")]
    return records.groupBy("src").agg(*columns)


def country_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("src", "country").agg(F.count(F.lit(1)).alias("n"))


def duplicate_counts(records: DataFrame) -> DataFrame:
    """(src, dup_names, dup_pairs): rows beyond the first of equal normalised names, and of equal (name, address).

    Two aggregates by key and then by source, which keep a hot name's rows apart from the rest of its source.
    """
    pairs = records.groupBy("src", "norm_name", "norm_address").agg(F.count(F.lit(1)).alias("n"))
    names = pairs.groupBy("src", "norm_name").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs"))
    sums = names.groupBy("src").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("names"), F.sum("pairs").alias("pairs"))
    return sums.select("src", (F.col("rows") - F.col("names")).cast("bigint").alias("dup_names"), (F.col("rows") - F.col("pairs")).cast("bigint").alias("dup_pairs"))


def top_tokens(records: DataFrame, k: int = 10) -> DataFrame:
    """(token, n): the k most frequent words of normalised names, ties by the word."""
    tokens = records.select(F.explode(F.split("norm_name", " ")).alias("token")).where("token <> ''")
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "token").limit(k)


def match_histogram(s1: DataFrame, links: DataFrame) -> DataFrame:
    """(n_matches, entities): how many known links the entities of `s1` have, 0 included."""
    counts = links.groupBy("s1_id").agg(F.countDistinct("target_id").alias("n"))
    joined = s1.select(F.col("entity_id").alias("s1_id")).join(counts, "s1_id", "left")
    return joined.groupBy(F.coalesce("n", F.lit(0)).alias("n_matches")).agg(F.count(F.lit(1)).alias("entities"))


def link_summary(s1: DataFrame, links: DataFrame) -> DataFrame:
    """One row: entities, singletons and their rate, links of these entities, and all links by source."""
    histogram = match_histogram(s1, links)
    totals = histogram.agg(
        F.coalesce(F.sum("entities"), F.lit(0)).alias("total_s1"),
        F.coalesce(F.sum(F.when(F.col("n_matches") == 0, F.col("entities"))), F.lit(0)).alias("singletons"),
        F.coalesce(F.sum(F.col("n_matches") * F.col("entities")), F.lit(0)).alias("total_matches"),
    )
    by_source = links.agg(F.count_if(F.startswith("target_id", F.lit("S2-"))).alias("s2_matches"), F.count_if(F.startswith("target_id", F.lit("S3-"))).alias("s3_matches"))
    rate = F.when(F.col("total_s1") > 0, F.col("singletons") / F.greatest("total_s1", F.lit(1))).otherwise(F.lit(0.0))
    return totals.join(by_source).withColumn("singleton_rate", rate)  # one row each


def name_overlap(records: DataFrame) -> DataFrame:
    """One row: distinct names of source 1, and those that source 2, source 3, or either has as well."""
    flags = records.where("norm_name <> ''").groupBy("norm_name").agg(*(F.max((F.col("src") == k).cast("int")).alias(f"s{k}") for k in (1, 2, 3)))
    in_1 = flags.where("s1 = 1")
    return in_1.agg(F.count(F.lit(1)).alias("s1_names"), F.count_if(F.col("s2") == 1).alias("in_s2"), F.count_if(F.col("s3") == 1).alias("in_s3"), F.count_if((F.col("s2") == 1) | (F.col("s3") == 1)).alias("in_either"))


def analyze(records: DataFrame, links: DataFrame | None = None) -> dict[str, DataFrame]:
    """All profiles by name."""
    out = {f.__name__: f(records) for f in (missing_fields, field_lengths, country_counts, duplicate_counts, top_tokens, name_overlap)}
    if links is not None:
        s1 = records.where("src = 1")
        out |= {"match_histogram": match_histogram(s1, links), "link_summary": link_summary(s1, links)}
    return out


