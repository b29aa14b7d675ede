"""Decision thresholds: choose the one with the best macro F0.5, and apply one to scored pairs.

Scored pairs are (s1_id, target_id, prob).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.metrics import f05, summary

#: The default grid, evenly spaced from its first to its last point.
FIRST, LAST, POINTS = 0.20, 0.95, 50
MOST_MATCHES = 10
NO_THRESHOLD, NO_SCORE = 0.50, -1.0


def grid(first: float = FIRST, last: float = LAST, points: int = POINTS) -> list[float]:
    return [first + (last - first) * k / max(points - 1, 1) for k in range(points)]


def threshold_sweep(scored: DataFrame, entities: DataFrame, links: DataFrame, points: list[float] | None = None) -> DataFrame:
    """A row for each threshold with all scores of `evaluate_predictions`.

    A pair passes the first `passed` points of the sorted grid. One aggregate counts an entity's predictions and
    hits for all points together, two counters each, so pairs are shuffled once and not once for each threshold.
    """
    points = sorted(points or grid())
    n = len(points)
    cuts = F.array(*(F.lit(p) for p in points))
    pairs = scored.groupBy("s1_id", "target_id").agg(F.max("prob").alias("prob"))
    true = links.select("s1_id", "target_id").distinct().withColumn("t", F.lit(1))
    judged = pairs.select("s1_id", "target_id", F.size(F.filter(cuts, lambda c: c <= F.col("prob"))).alias("passed"), F.lit(0).alias("t"))
    judged = judged.union(true.select("s1_id", "target_id", F.lit(-1), "t")).groupBy("s1_id", "target_id").agg(F.max("passed").alias("passed"), F.max("t").alias("t"))
    counters = [F.count_if(F.col("passed") > k).alias(f"p{k}") for k in range(n)] + [F.sum(F.when(F.col("passed") > k, F.col("t")).otherwise(F.lit(0))).alias(f"h{k}") for k in range(n)]
    each = judged.groupBy("s1_id").agg(F.sum("t").alias("n_true"), *counters)
    rows = entities.select("s1_id").distinct().join(each, "s1_id", "left")
    at = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(p).alias("threshold"), F.coalesce(f"p{k}", F.lit(0)).alias("n_pred"), F.coalesce(f"h{k}", F.lit(0)).alias("tp")) for k, p in enumerate(points))))
    rows = rows.select("s1_id", F.coalesce("n_true", F.lit(0)).alias("n_true"), at.alias("x")).select("s1_id", "n_true", "x.*")
    score = f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))
    return rows.groupBy("threshold").agg(*summary(score, F.col("n_pred"), F.col("n_true"), F.col("tp")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of `threshold_sweep` with the best macro F0.5; the lowest threshold of equals."""
    return sweep.orderBy(F.desc("macro_f05"), F.asc("threshold")).limit(1)


def optimize_f05_threshold(scored: DataFrame, entities: DataFrame, links: DataFrame, points: list[float] | None = None) -> tuple[float, float, dict]:
    row = best_threshold(threshold_sweep(scored, entities, links, points)).first()
    return (row.threshold, row.macro_f05, row.asDict()) if row else (NO_THRESHOLD, NO_SCORE, {})


def matches(scored: DataFrame, threshold: float, most: int = MOST_MATCHES) -> DataFrame:
    """(s1_id, target_id, prob, rank): the best pairs from the threshold on, ties by target_id."""
    passed = scored.where(F.col("prob") >= threshold).groupBy("s1_id", "target_id").agg(F.max("prob").alias("prob"))
    order = Window.partitionBy("s1_id").orderBy(F.desc("prob"), "target_id")
    return passed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def apply_threshold(scored: DataFrame, s1: DataFrame, threshold: float, most: int = MOST_MATCHES) -> DataFrame:
    """(s1_id, matched_ids): one row for each entity of `s1`, an empty list where nothing passes."""
    lists = matches(scored, threshold, most).groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "target_id"))), lambda x: x["target_id"]).alias("matched_ids"))
    out = s1.select("s1_id").distinct().join(lists, "s1_id", "left")
    return out.select("s1_id", F.coalesce("matched_ids", F.array().cast("array<string>")).alias("matched_ids"))
