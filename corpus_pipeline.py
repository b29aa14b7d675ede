"""A corpus pipeline: quality, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of `documents`.
A caller may write each stage's rows and read them again for the next, as a scheduler would; `run` checkpoints
them instead, so that a stage that reads its input more than once doesn't repeat the stages before it.

1. quality_classifier drops documents that score under the classifier's threshold. Without labels of both
   classes it keeps everything.
2. ngram_jaccard_join keeps the smallest doc_id of each component of documents that are linked by a Jaccard
   similarity of 0.8 or more over five-word shingles. Documents without words are linked with nothing.
3. benchmark_decontamination drops documents in which tiles cover half of a benchmark item or more.
4. secret_scan replaces every secret by a mark and counts n_chars anew.
5. best_fit_packing returns the pieces of all that is left and their places in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weftline.llm import decontaminate, jaccard_join, packing, quality, secrets
from weftline.llm.common import checkpoint, table

TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no form for the classifier and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        rows = stage(spark, checkpoint(rows) if k else rows, sf_dir)
    return rows
