"""Linkage runs: candidates, features, training, calibration and checkpointed inference."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.checkpoints import checkpoint
from weftline.operators import blocking, metrics, threshold
from weftline.operators.blocking import Blocker, BlockingConfig
from weftline.operators.features import pair_features
from weftline.operators.models import EntityClassifier, dealt

#: Candidates an entity when training and when inferring, and the default threshold.
TRAIN_CANDIDATES, TEST_CANDIDATES, THRESHOLD = 75, 120, 0.919


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """`df` as a parquet table that is written once and read from then on; without a path, as a checkpoint."""
    if path is None:
        return checkpoint(df)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass
class Linker:
    """Facade: `candidates`, `features`, `fit`, `predict`, `infer` over a records table."""

    config: BlockingConfig = field(default_factory=BlockingConfig)
    model_type: str = "ensemble"
    threshold: float = THRESHOLD
    classifier: EntityClassifier | None = None

    def candidates(self, records: DataFrame, most: int | None = None) -> DataFrame:
        config = self.config if most is None else BlockingConfig(**(asdict(self.config) | {"max_total_candidates": most}))
        return Blocker(config).candidates(records)

    def features(self, pairs: DataFrame, records: DataFrame, *rest: str) -> DataFrame:
        """Features of `pairs`, which should be stored: they are read twice, so that profiles are made of their records alone."""
        needed = pairs.select(F.explode(F.array("s1_id", "target_id")).alias("entity_id"))
        return pair_features(pairs.select("s1_id", "target_id", *rest), records.join(needed, "entity_id", "left_semi"))

    def fit(self, records: DataFrame, entities: DataFrame, links: DataFrame, store: str | None = None) -> dict:
        """Train on all candidate pairs, choose the threshold on the last fold, and score the other folds with it.

        Entities without a candidate pair are absent from the scores named `scored_*` and present in `all_*`.
        """
        found = stored(self.candidates(records, TRAIN_CANDIDATES), store and f"{store}/candidates")
        label = links.select("s1_id", "target_id").distinct().withColumn("label", F.lit(1))
        pairs = found.select("s1_id", "target_id").join(label, ["s1_id", "target_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
        pairs = stored(dealt(pairs), store and f"{store}/folds")
        pairs = stored(self.features(pairs, records, "label", "fold"), store and f"{store}/pairs")
        self.classifier = EntityClassifier(self.model_type)
        scored = stored(self.classifier.train_cv(pairs), store and f"{store}/scores")

        def part(holdout: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
            rows = scored.where(F.col("holdout") == holdout)
            ids = rows.select("s1_id").distinct()
            return rows, ids.join(entities, "s1_id", "left_semi"), links.join(ids, "s1_id", "left_semi")

        self.threshold, best, _ = threshold.optimize_f05_threshold(*part(True))
        rows, ids, known = part(False)
        kept = rows.where(F.col("prob") >= self.threshold)
        report = {"threshold": self.threshold, "holdout_f05": best}
        report |= {f"scored_{k}": v for k, v in metrics.evaluate_predictions(kept, ids, known).first().asDict().items()}
        every = scored.where(F.col("prob") >= self.threshold)
        report |= {f"all_{k}": v for k, v in metrics.evaluate_predictions(every, entities, links).first().asDict().items()}
        n_s1, n_target = records.agg(F.count_if(F.col("src") == 1), F.count_if(F.col("src") != 1)).first()
        return report | metrics.evaluate_blocking(found, links, n_s1, n_target).first().asDict()

    def predict(self, pairs: DataFrame, records: DataFrame) -> DataFrame:
        """(s1_id, target_id, prob) of candidate pairs."""
        if self.classifier is None:
            raise RuntimeError("Classifier has not been trained yet.")
        return self.classifier.predict_proba(self.features(pairs, records)).select("s1_id", "target_id", "prob")

    def fingerprint(self, records: DataFrame) -> str:
        """What a run depends on: a run with other parameters or other records resumes nothing of it."""
        row = F.xxhash64("entity_id", "src", "norm_name", "norm_address", "norm_country").cast("decimal(38,0)")
        seen = [str(v) for v in records.agg(F.count(F.lit(1)), F.sum(row)).first()]
        about = [asdict(self.config), self.model_type, self.threshold, TEST_CANDIDATES, self.classifier and [[m.uid for m in f] for f in self.classifier.models], seen]
        return hashlib.sha256(json.dumps(about).encode()).hexdigest()[:16]

    def infer(self, records: DataFrame, folder: str) -> DataFrame:
        """(s1_id, candidate_ids, matched_ids, norm_country) of every entity of source 1, resumable by country.

        Candidates and results are tables partitioned by country under a folder that carries the parameters'
        fingerprint. Countries that are there are skipped, all others are written together in one job, whose
        writer replaces whole partitions.
        """
        spark, base = records.sparkSession, f"{folder}/{self.fingerprint(records)}"
        s1 = records.where("src = 1").select(F.col("entity_id").alias("s1_id"), "norm_country")

        def done(path: str) -> list[str]:
            from weftline.sources.tsv import exists

            return [r[0] for r in spark.read.parquet(path).select("norm_country").distinct().collect()] if exists(spark, f"{path}/_SUCCESS") else []

        def write(df: DataFrame, path: str) -> None:
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("norm_country").parquet(path)

        finished = done(f"{base}/results")
        todo = records if not finished else records.where(~F.col("norm_country").isin(finished))
        if not todo.isEmpty():
            blocked = done(f"{base}/candidates")
            rest = todo if not blocked else todo.where(~F.col("norm_country").isin(blocked))
            if not rest.isEmpty():
                found = self.candidates(rest, TEST_CANDIDATES).select("s1_id", "target_id", "rank")
                write(s1.join(rest.select("norm_country").distinct(), "norm_country", "left_semi").join(found, "s1_id", "left"), f"{base}/candidates")
            found = spark.read.parquet(f"{base}/candidates").join(todo.select("norm_country").distinct(), "norm_country", "left_semi")
            pairs = found.where("target_id is not null").select("s1_id", "target_id", "rank")
            scored = self.predict(pairs, todo)
            open_s1 = todo.where("src = 1")
            lists = blocking.nested(pairs, open_s1).join(threshold.apply_threshold(scored, open_s1.select(F.col("entity_id").alias("s1_id")), self.threshold), "s1_id")
            extra = F.array_except("matched_ids", "candidate_ids")
            lists = lists.withColumn("candidate_ids", F.concat("candidate_ids", extra))
            write(lists.join(s1, "s1_id"), f"{base}/results")
        return spark.read.parquet(f"{base}/results").select("s1_id", "candidate_ids", "matched_ids", "norm_country")


def coverage(results: DataFrame) -> DataFrame:
    """One row: entities, those with a match, and their percentage."""
    return results.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.size("matched_ids") > 0).alias("matched"), (F.avg((F.size("matched_ids") > 0).cast("double")) * 100).alias("matched_pct"))
