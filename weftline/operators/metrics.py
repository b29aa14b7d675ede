"""Scores of predictions and of candidate generation against known links, as aggregates.

Truth is two tables, so that entities without links survive: `entities` (s1_id) and `links` (s1_id, target_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def f05(tp: Column, predicted: Column, true: Column) -> Column:
    """F0.5 of one entity; an entity without links scores 1 if nothing is predicted for it."""
    precision, recall = tp / F.greatest(predicted, F.lit(1)), tp / F.greatest(true, F.lit(1))
    score = 1.25 * precision * recall / F.when(tp > 0, 0.25 * precision + recall).otherwise(F.lit(1.0))
    return F.when(true == 0, (predicted == 0).cast("double")).when(tp == 0, F.lit(0.0)).otherwise(score)


def entity_counts(predictions: DataFrame, entities: DataFrame, links: DataFrame) -> DataFrame:
    """(s1_id, n_pred, n_true, tp) of each known entity; predictions for others don't count.

    One shuffle by entity: predictions and links meet in an aggregate over their union instead of a full join.
    """
    said = predictions.select("s1_id", "target_id", F.lit(1).alias("p"), F.lit(0).alias("t"))
    true = links.select("s1_id", "target_id", F.lit(0).alias("p"), F.lit(1).alias("t"))
    pairs = said.union(true).groupBy("s1_id", "target_id").agg(F.max("p").alias("p"), F.max("t").alias("t"))
    counts = pairs.groupBy("s1_id").agg(F.sum("p").alias("n_pred"), F.sum("t").alias("n_true"), F.sum(F.col("p") * F.col("t")).alias("tp"))
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_pred", "n_true", "tp")]
    return entities.select("s1_id").distinct().join(counts, "s1_id", "left").select("s1_id", *zero)


def entity_f05(predictions: DataFrame, entities: DataFrame, links: DataFrame) -> DataFrame:
    return entity_counts(predictions, entities, links).withColumn("f05", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def summary(score: Column, n_pred: Column, n_true: Column, tp: Column) -> list[Column]:
    single = n_true == 0

    def mean(of: Column, empty: float) -> Column:
        return F.coalesce(F.avg(of), F.lit(empty))

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / F.greatest(whole, F.lit(1))).otherwise(F.lit(0.0))

    return [
        mean(score, 0.0).alias("macro_f05"),
        F.count_if(single).alias("singleton_count"),
        mean(F.when(single, score), 1.0).alias("singleton_accuracy"),
        F.count_if(~single).alias("non_singleton_count"),
        mean(F.when(~single, score), 0.0).alias("non_singleton_f05"),
        ratio(F.sum(tp), F.sum(n_pred)).alias("overall_micro_precision"),
        ratio(F.sum(tp), F.sum(n_true)).alias("overall_micro_recall"),
        F.coalesce(F.sum(n_pred), F.lit(0)).cast("bigint").alias("total_predictions"),
        F.coalesce(F.sum(n_true), F.lit(0)).cast("bigint").alias("total_true_links"),
        F.coalesce(F.sum(n_pred - tp), F.lit(0)).cast("bigint").alias("total_false_positives"),
    ]


def evaluate_predictions(predictions: DataFrame, entities: DataFrame, links: DataFrame) -> DataFrame:
    """One row: macro, singleton and micro scores over all known entities."""
    return entity_f05(predictions, entities, links).agg(*summary(F.col("f05"), F.col("n_pred"), F.col("n_true"), F.col("tp")))


def compute_macro_f05(predictions: DataFrame, entities: DataFrame, links: DataFrame) -> DataFrame:
    return evaluate_predictions(predictions, entities, links).select("macro_f05", "singleton_accuracy", "non_singleton_f05")


def evaluate_blocking(candidates: DataFrame, links: DataFrame, n_s1: Column | int, n_target: Column | int) -> DataFrame:
    """One row: recall ceiling, captured and total links, candidates, reduction ratio, candidates an entity."""
    found = candidates.select("s1_id", "target_id", F.lit(1).alias("c"), F.lit(0).alias("t"))
    true = links.select("s1_id", "target_id", F.lit(0).alias("c"), F.lit(1).alias("t"))
    pairs = found.union(true).groupBy("s1_id", "target_id").agg(F.max("c").alias("c"), F.max("t").alias("t"))
    sums = pairs.agg(*(F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias(k) for k, v in (("captured_links", F.col("c") * F.col("t")), ("total_gt_links", F.col("t")), ("total_candidates", F.col("c")))))
    n_s1, n_target = (F.lit(n) if isinstance(n, int) else n for n in (n_s1, n_target))
    cells = n_s1.cast("double") * n_target.cast("double")  # the product soon leaves the range of an integer
    return sums.select(
        F.when(F.col("total_gt_links") > 0, F.col("captured_links") / F.greatest("total_gt_links", F.lit(1))).otherwise(F.lit(1.0)).alias("blocking_recall"),
        "captured_links",
        "total_gt_links",
        "total_candidates",
        F.when(cells > 0, 1 - F.col("total_candidates") / F.greatest(cells, F.lit(1.0))).otherwise(F.lit(1.0)).alias("reduction_ratio"),
        F.when(n_s1 > 0, F.col("total_candidates") / F.greatest(n_s1, F.lit(1))).otherwise(F.lit(0.0)).alias("avg_candidates_per_s1"),
    )
