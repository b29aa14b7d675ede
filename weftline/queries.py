"""The linkage queries over the derived records: each applies one operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import keys, text
from weftline.operators import blocking, features, metrics, models, profiling, threshold, validation
from weftline.plans.linker import stored
from weftline.sources import entities

Query = Callable[[SparkSession, str], DataFrame]
#: The score from which the evaluation queries predict a match.
PASSED = 0.5


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


def joined(c: Column, by: str = ",") -> Column:
    return F.array_join(c, by)


def norm_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.records(spark, sf_dir).select("entity_id", "norm_name", "norm_address", "norm_country")


def geo_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.raw_entities(spark, sf_dir).select("entity_id", joined(text.numbers(F.col("business_address"))).alias("geos"))


def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocking.parsed(entities.records(spark, sf_dir))
    telling = keys.telling(F.col("words"))
    return rows.select("entity_id", "core", keys.sorted_tokens(F.col("core")).alias("sorted_tokens"), F.col("spaceless").alias("unspaced"), joined(F.slice("words", 1, 2), " ").alias("first_two"), joined(telling).alias("telling"))


def char_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.records(spark, sf_dir).select("entity_id", joined(keys.ngrams(F.col("norm_name"), 4), "|").alias("grams"))


def address_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.parsed(entities.records(spark, sf_dir)).select("entity_id", joined(F.col("nums")).alias("nums"), joined(F.col("streets")).alias("streets"))


def phonetic_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("norm_name")
    return entities.records(spark, sf_dir).select("entity_id", keys.first_sounds(name).alias("phonetic"), keys.first_sounds(name, keys.metaphone, " ").alias("metaphone"))


def block_channel(channel: blocking.Channel) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cast = blocking.hits(entities.records(spark, sf_dir), only=(channel.number,))
        return cast.groupBy("s1_id", "target_id").agg(F.sum("weight").cast("bigint").alias("votes"))

    return query


def block_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.votes(blocking.hits(entities.records(spark, sf_dir))).select("s1_id", "target_id", "votes")


def block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.candidates(entities.records(spark, sf_dir))


def blocking_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.records(spark, sf_dir)
    _, links = entities.truth(records)
    n_s1, n_target = records.agg(F.count_if(F.col("src") == 1), F.count_if(F.col("src") != 1)).first()
    return rounded(metrics.evaluate_blocking(blocking.candidates(records), links, n_s1, n_target))


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features; two of them, the partial ratios, have no form in SQL, so the others are checked on their own."""
    records = entities.records(spark, sf_dir)
    return rounded(features.pair_features(blocking.candidates(records).select("s1_id", "target_id"), records))


def chosen(*columns: str) -> Query:
    return lambda spark, sf_dir: pair_features(spark, sf_dir).select("s1_id", "target_id", *columns)


set_features = chosen(*"name_word_jaccard name_ngram_jaccard name_4gram_jaccard first_word_match last_word_match addr_word_jaccard geo_jaccard has_common_geo contradictory_geo addr_first_num_match addr_num_jaccard name_containment_s1 name_containment_t name_len_diff name_len_ratio s1_missing_addr t_missing_addr country_match".split())
string_features = chosen(*"name_ratio name_token_sort addr_ratio name_jw addr_jw full_jw name_token_set addr_token_set name_phonetic_sim".split())


def scored(records: DataFrame) -> DataFrame:
    """Candidate pairs with a score that needs no model: the mean word Jaccard of name and address."""
    words = records.select("entity_id", F.array_distinct(keys.tokens(F.col("norm_name"))).alias("n"), F.array_distinct(keys.tokens(F.col("norm_address"))).alias("a"))
    left = words.toDF("s1_id", "ln", "la")
    right = words.toDF("target_id", "rn", "ra")
    pairs = blocking.candidates(records).select("s1_id", "target_id").join(left, "s1_id").join(right, "target_id")
    prob = (keys.jaccard(F.col("ln"), F.col("rn")) + keys.jaccard(F.col("la"), F.col("ra"))) / 2
    return pairs.select("s1_id", "target_id", F.round(prob, 9).alias("prob"))


def entity_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.records(spark, sf_dir)
    return rounded(metrics.entity_f05(scored(records).where(F.col("prob") >= PASSED), *entities.truth(records)))


def evaluate_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.records(spark, sf_dir)
    return rounded(metrics.evaluate_predictions(scored(records).where(F.col("prob") >= PASSED), *entities.truth(records)))


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.records(spark, sf_dir)
    return rounded(threshold.threshold_sweep(scored(records), *entities.truth(records)))


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold.best_threshold(threshold_sweep(spark, sf_dir))


def apply_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.records(spark, sf_dir)
    lists = threshold.apply_threshold(scored(records), entities.truth(records)[0], PASSED)
    return lists.select("s1_id", joined(F.col("matched_ids")).alias("matched_ids"))


def profile(operator: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = rounded(operator(entities.records(spark, sf_dir)))
        return out.select(*columns) if columns else out

    return query


def linked_profile(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = entities.records(spark, sf_dir)
        return rounded(operator(records.where("src = 1"), entities.truth(records)[1]))

    return query


def validation_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a result file over all records, each source standing for one kind of row."""
    records = entities.records(spark, sf_dir)
    rows = records.select(F.col("ord").alias("no"), F.col("entity_id").alias("value"), F.when(F.col("src") == 2, F.lit("S1-none")).otherwise(F.col("entity_id")).alias("s1_id"), F.array(F.col("entity_id"), F.col("norm_country"), F.col("norm_country")).alias("ids"), (F.col("src") != 3).alias("has_tab"))
    required = records.where("src <> 2").select(F.col("entity_id").alias("s1_id"))
    valid = records.where("src = 3").select(F.col("entity_id").alias("target_id"))
    return validation.check_rows(rows, required, "matching", valid).select("severity", "rule", "file", "n", F.array_join("examples", ",").alias("examples"))


def group_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, _ = entities.truth(entities.records(spark, sf_dir))
    return s1.withColumn("fold", models.fold_of(F.col("s1_id"), models.CV_SPLITS))


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold scores of all candidate pairs; a fitted model has no form in SQL."""
    records = entities.records(spark, sf_dir)
    known = entities.truth(records)[1].withColumn("label", F.lit(1))
    pairs = blocking.candidates(records).select("s1_id", "target_id").join(known, ["s1_id", "target_id"], "left")
    pairs = models.dealt(stored(pairs.withColumn("label", F.coalesce("label", F.lit(0)))))
    pairs = features.pair_features(pairs, records)  # labels and folds are joined before there are features
    return models.EntityClassifier("logistic_regression").train_cv(pairs)


def queries() -> dict[str, Query]:
    plain = (norm_records, geo_tokens, name_keys, char_ngrams, address_blocks, phonetic_keys, block_votes, block_topk, blocking_quality, pair_features, entity_f05, evaluate_predictions, threshold_sweep, best_threshold, apply_threshold, validation_findings, group_folds, model_scores)
    out: dict[str, Query] = {f.__name__: f for f in plain}
    out |= {"set_features": set_features, "string_features": string_features}
    out |= {f"block_{c.name}": block_channel(c) for c in blocking.channels()}
    out["eda_missing"] = profile(profiling.missing_fields, *"src total_rows missing_name missing_address missing_country missing_address_pct".split())
    out["eda_lengths"] = profile(profiling.field_lengths)
    out["eda_countries"] = profile(profiling.country_counts)
    out["eda_duplicates"] = profile(profiling.duplicate_counts)
    out["eda_top_tokens"] = profile(profiling.top_tokens)
    out["eda_overlap"] = profile(profiling.name_overlap)
    out["match_histogram"] = linked_profile(profiling.match_histogram)
    out["link_summary"] = linked_profile(profiling.link_summary)
    return out
