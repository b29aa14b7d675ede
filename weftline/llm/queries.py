"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weftline.llm import decontaminate, fingerprint, html_extract, jaccard_join, packing, quality, secrets, sharding, substring_dedup, toxicity
from weftline.llm.common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_html_extraction,
        op2_toxicity,
        op3_quality,
        op4_fingerprint,
        op5_secret_scan,
        op6_kd_sharding,
        op7_ngram_jaccard_join,
        op8_benchmark_decontamination,
        op9_substring_dedup,
        op10_best_fit_packing,
    )
    return {f.__name__: f for f in found}


WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every pair of documents that share a shingle is counted, and links are followed to their ends.
NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * c >= 90 * (na + nb - c)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.c FROM r JOIN l ON r.doc_id = l.a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, m.c AS component_id FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m USING (doc_id)
"""

#: Every window of fifty words is compared by its text.
REPEATED_PASSAGES = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 49)) AS s FROM d WHERE len(w) >= 50),
x AS (SELECT p.doc_id, s, array_to_string(w[s:s + 49], ' ') AS t FROM p JOIN d USING (doc_id)),
f AS (SELECT t, min(doc_id) AS first FROM x GROUP BY t),
z AS (SELECT x.doc_id, list(s) AS starts FROM x JOIN f ON x.t = f.t AND f.first < x.doc_id GROUP BY x.doc_id),
k AS (SELECT d.doc_id, w, CASE WHEN starts IS NULL THEN w ELSE list_filter(w, lambda y, i: len(list_filter(starts, lambda s: s <= i AND s > i - 50)) = 0) END AS kept FROM d LEFT JOIN z USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


def oracle_sql() -> dict[str, str]:
    """The classifiers, the tokenizer, the hashes and the tree have no form in SQL; tests hold them against brute force."""
    return {"op7_ngram_jaccard_join": NEAR_DUPLICATES, "op9_substring_dedup": REPEATED_PASSAGES}
