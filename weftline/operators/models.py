"""Pair classifiers: cross-validation grouped by entity, on Spark ML, with a saved form.

Boosted trees stand for both boosting models of a single machine; their number of rounds is a parameter, smaller
by default than a single machine's, and the contract is the score they reach, not equal numbers.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, SparkSession
from pyspark.sql import functions as F

from weftline.operators import logistic
from weftline.operators.features import FEATURE_COLUMNS

CV_SPLITS = 5
#: Models of different folds whose scores are averaged on new pairs.
EVALUATED = 2
MOST_WEIGHT = 10.0
ROUNDS = 40
MODEL_TYPES = ("ensemble", "lightgbm", "xgboost", "random_forest", "logistic_regression")


def fold_of(s1_id: Column, n: int) -> Column:
    """The fold of an entity, by a hash: all its pairs are in one fold, and nothing is gathered to say so."""
    return (F.conv(F.substring(F.md5(s1_id), 1, 8), 16, 10).cast("bigint") % n).cast("int")


def balanced_folds(pairs: DataFrame, n: int, buckets: int = 64) -> DataFrame:
    """(s1_id, fold): entities in order of their pairs, dealt to the folds to and fro, so that loads are near equal.

    The order is numbered by (pairs, bucket of a hash), so no task numbers all entities; only counts meet in one.
    """
    sized = pairs.groupBy("s1_id").agg(F.count(F.lit(1)).alias("size")).withColumn("bucket", F.pmod(F.xxhash64("s1_id"), F.lit(buckets)))
    before = Window.orderBy(F.desc("size"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized.groupBy("size", "bucket").count().select("size", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("size", "bucket").orderBy("s1_id")) - 1
    turn = ((F.col("own") + F.col("start")) % (2 * n)).cast("int")
    return sized.withColumn("own", own).join(starts, ["size", "bucket"]).select("s1_id", F.when(turn < n, turn).otherwise(2 * n - 1 - turn).alias("fold"))


def n_folds(pairs: DataFrame, n_splits: int = CV_SPLITS) -> int:
    """`n_splits`, or the number of entities where there are fewer, but two."""
    return max(min(n_splits, pairs.select("s1_id").distinct().limit(n_splits).count()), 2)


def dealt(pairs: DataFrame, n_splits: int = CV_SPLITS) -> DataFrame:
    """`pairs`, which should be stored and have no features yet, with the `fold` of their entity."""
    return pairs.join(balanced_folds(pairs, n_folds(pairs, n_splits)), "s1_id")


def boosted(seed: int, depth: int, rounds: int) -> GBTClassifier:
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.7", seed=seed, weightCol="weight", validationIndicatorCol="aside", maxBins=64)


class EntityClassifier:
    """Facade: `train_cv`, `predict_proba`, `save`, `load`."""

    def __init__(self, model_type: str = "lightgbm", rounds: int = ROUNDS) -> None:
        if model_type not in MODEL_TYPES:
            raise ValueError(f"unknown model type {model_type}")
        self.model_type, self.rounds = model_type, rounds
        self.models: list[list[Model]] = []
        self.assembler = VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features")

    def estimators(self) -> list[Estimator]:
        makers: dict[str, Callable[[], list[Estimator]]] = {
            "lightgbm": lambda: [boosted(42, 5, self.rounds)],
            "xgboost": lambda: [boosted(43, 6, self.rounds)],
            "ensemble": lambda: [boosted(42, 5, self.rounds), boosted(43, 6, self.rounds)],
            "random_forest": lambda: [RandomForestClassifier(numTrees=150, maxDepth=10, seed=42, weightCol="weight")],
        }
        return makers[self.model_type]()

    def weight(self, positives: int, negatives: int) -> Column:
        """Boosted trees weigh positives by the classes' ratio, ten at most; the others balance both classes."""
        ratio = negatives / max(positives, 1) if positives else 1.0
        if self.model_type == "random_forest":
            other, one = self.balanced(positives, negatives)
            return F.when(F.col("label") == 1, one).otherwise(other)
        return F.when(F.col("label") == 1, F.lit(min(ratio, MOST_WEIGHT))).otherwise(F.lit(1.0))

    @staticmethod
    def balanced(positives: int, negatives: int) -> tuple[float, float]:
        """Weights of a pair of label 0 and of label 1 by which both labels weigh the same."""
        total = positives + negatives
        return total / (2 * max(negatives, 1)), total / (2 * max(positives, 1))

    def train_cv(self, pairs: DataFrame, n_splits: int = CV_SPLITS, folds: DataFrame | None = None) -> DataFrame:
        """(s1_id, target_id, label, fold, prob, holdout): out-of-fold scores; the last fold is for the threshold.

        `pairs` should have the `fold` of `dealt`: folds that are joined here are joined to all features. Logistic
        regressions read `pairs` once, store them packed and fit all folds in the same passes. Folds of other models
        are fitted one after another, each on all executors, and read `pairs` several times, so that it should be stored.
        """
        if self.model_type == "logistic_regression":
            return self.train_logistic(pairs, n_splits, folds)
        n = n_folds(pairs, n_splits)
        rows = pairs if "fold" in pairs.columns and folds is None else pairs.drop("fold").join(balanced_folds(pairs, n) if folds is None else folds, "s1_id")
        rows = self.assembler.transform(rows.withColumn("label", F.col("label").cast("double"))).select("s1_id", "target_id", "label", "fold", "features")
        counts = {(r.fold, r.label): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
        n = max(n, 1 + max((f for f, _ in counts), default=0))  # a fold's pairs are scored even if others were lost
        self.models, scored = [], None
        for k in range(n):
            positives, negatives = (sum(v for (f, y), v in counts.items() if f != k and y == label) for label in (1.0, 0.0))
            part = rows.withColumn("weight", self.weight(positives, negatives)).withColumn("aside", F.col("fold") == k)
            fitted = [e.fit(part if isinstance(e, GBTClassifier) else part.where("not aside")) for e in self.estimators()]
            self.models.append(fitted)
            out = self.average(rows.where(F.col("fold") == k), [fitted])
            scored = out if scored is None else scored.unionByName(out)
        return scored.select("s1_id", "target_id", "label", "fold", "prob", (F.col("fold") == n - 1).alias("holdout"))

    def train_logistic(self, pairs: DataFrame, n_splits: int, folds: DataFrame | None) -> DataFrame:
        if folds is not None or "fold" not in pairs.columns:
            pairs = pairs.drop("fold").join(balanced_folds(pairs, n_folds(pairs, n_splits)) if folds is None else folds, "s1_id")
        blocks = logistic.packed(pairs.withColumns({"label": F.col("label").cast("double"), "fold": F.col("fold").cast("int")}), list(FEATURE_COLUMNS))
        seen = logistic.look(blocks, len(FEATURE_COLUMNS), n_splits)
        n = max(min(n_splits, len(seen.entities)), 2, 1 + max((f for f, _ in seen.counts), default=0))
        fitted = logistic.fit(blocks, len(FEATURE_COLUMNS), seen, n, self.balanced)
        self.models = [[logistic.model(pairs, *f)] for f in fitted]
        return logistic.scores(blocks, fitted)

    @staticmethod
    def average(rows: DataFrame, models: list[list[Model]]) -> DataFrame:
        """Add `prob`: the mean over folds of the mean over a fold's models."""
        each = []
        for fold in models:
            for m in fold:
                name = f"prob_{len(each)}"
                rows = m.transform(rows).withColumn(name, vector_to_array("probability")[1] / len(fold)).drop("rawPrediction", "probability", "prediction")
                each.append(name)
        return rows.withColumn("prob", sum((F.col(c) for c in each[1:]), F.col(each[0])) / len(models)).drop(*each)

    def predict_proba(self, pairs: DataFrame, n_models: int = EVALUATED) -> DataFrame:
        """`pairs` with `prob`, averaged over the first models if there are more."""
        if not self.models:
            raise RuntimeError("Classifier has not been trained yet.")
        models = self.models[:n_models] if len(self.models) > n_models else self.models
        return self.average(self.assembler.transform(pairs), models).drop("features")

    def save(self, path: str) -> None:
        flat = [m for fold in self.models for m in fold]
        PipelineModel(flat).write().overwrite().save(f"{path}/models")
        spark = SparkSession.getActiveSession()
        about = {"type": self.model_type, "rounds": self.rounds, "folds": [len(f) for f in self.models], "features": list(FEATURE_COLUMNS)}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> EntityClassifier:
        about = json.loads(SparkSession.getActiveSession().read.text(f"{path}/about").first().value)
        out = cls(about["type"], about["rounds"])
        flat = iter(PipelineModel.load(f"{path}/models").stages)
        out.models = [[next(flat) for _ in range(n)] for n in about["folds"]]
        return out
