"""Canonical exact fingerprints: normalise, fold, hash wide, compare bytes inside equal buckets.

A text's canonical form is NFKC, case-folded, with white space runs as one space; its fingerprint is 128 bits of
xxhash over that form. Buckets of equal fingerprints are confirmed by comparing the canonical bytes; should two
forms ever share 128 bits, the fingerprints of that bucket carry the form's SHA-256 as well. Everything is
DataFrame and SQL functions: normalisation and folding call the ICU library that Spark ships, by `reflect`.

The next document in descending doc_id is found without a global sort of texts: doc_ids are dealt by quantiles
into buckets of about `ROWS` documents (at most as many buckets as may be broadcast), each bucket also gets a copy of the first document of the bucket below (at most one
for each bucket), and `lead` runs inside buckets. Texts cross the network once.

Defined cases: a null text is empty; rows with the same doc_id follow each other by their texts' hash; the only
document of a table is its own next; a very long text is hashed whole; an empty table gives no rows; further columns are not carried.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_ROWS, checkpoint

#: Rows of a bucket of neighbouring doc_ids; fan-out of the lookup of a doc_id's bucket.
SIDE, ROWS = 64, 2_000
WHITE = r"[\s\p{Z}\x1c-\x1f\x85]+"


def canonical(text: Column) -> Column:
    def composed(c: Column) -> Column:
        return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))

    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), composed(F.coalesce(text, F.lit(""))), F.lit(True))
    return F.trim(F.regexp_replace(composed(folded), WHITE, " "))


def wide_hash(form: Column) -> Column:
    """128 bits in hex: xxhash64 under Spark's seed and under one drawn from a constant."""
    parts = (F.xxhash64(form), F.xxhash64(F.lit("weftline"), form))
    return F.concat(*(F.lpad(F.lower(F.hex(p)), 16, "0") for p in parts))


def bucket_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted `bounds` lie at or below doc_id, by rounds over SIDE values at most each."""
    level, found = 1, F.lit(0)
    while level * SIDE < len(bounds):
        level *= SIDE
    while level:
        values = F.from_json(F.lit(json.dumps(bounds[::level])), "array<bigint>")  # folded into one literal
        near = values if level * SIDE >= len(bounds) else F.slice(values, found * SIDE + 1, F.lit(SIDE))
        base = F.lit(0) if level * SIDE >= len(bounds) else found * SIDE
        passed = base + F.size(F.filter(near, lambda b: b <= doc_id))
        found = passed.cast("int") if level == 1 else F.greatest(passed - 1, F.lit(0)).cast("int")
        level //= SIDE
    return found


def with_next(rows: DataFrame) -> DataFrame:
    """`rows` (doc_id, text, tie, digest) with the next row's text and digest in descending doc_id."""
    count, least = rows.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    n = max(1, min(BROADCAST_ROWS, -(-count // ROWS)))
    shares = [k / n for k in range(1, n)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, max(100 * SIDE, 2 * n))).first()[0] or [])) if shares and count else []
    bounds = [b for b in bounds if b > least]
    rows = rows.withColumn("bucket", bucket_of(F.col("doc_id"), bounds) if bounds else F.lit(0))
    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head")).collect()  # one a bucket
    heads = sorted((r.bucket, r.head.doc_id, r.head.tie) for r in heads)
    after = [(heads[k][0], *heads[k - 1][1:]) for k in range(len(heads))]  # the lowest is followed by the highest
    spark = rows.sparkSession
    ids = spark.createDataFrame([(d, t, b) for b, d, t in after], "doc_id bigint, tie bigint, target int")
    copies = rows.join(F.broadcast(ids), ["doc_id", "tie"]).select("doc_id", "text", "tie", "digest", F.col("target").alias("bucket"), F.lit(True).alias("copy"))
    whole = rows.withColumn("copy", F.lit(False)).select("doc_id", "text", "tie", "digest", "bucket", "copy").union(copies)
    order = Window.partitionBy("bucket").orderBy("copy", F.desc("doc_id"), F.desc("tie"))
    followed = whole.withColumns({"next_text": F.lead("text").over(order), "next_digest": F.lead("digest").over(order)})
    return followed.where("not copy").drop("bucket", "copy")


def collided(forms: DataFrame, marked: DataFrame) -> list[str]:
    """Digests that stand for more than one canonical form. `forms`: (digest, text) of all documents."""
    shared = marked.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("sha").alias("low"), F.max("sha").alias("high"))
    shared = checkpoint(shared.where("n > 1"))
    unlike = {r.digest for r in shared.where("low != high").select("digest").collect()}
    keys = shared.where("low = high").select("digest")
    keys = F.broadcast(keys) if shared.count() <= BROADCAST_ROWS else keys
    inside = forms.join(keys, "digest", "left_semi").select("digest", canonical(F.col("text")).alias("form"))
    bytewise = inside.groupBy("digest", "form").agg(F.count(F.lit(1))).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return sorted(unlike | {r.digest for r in bytewise.select("digest").collect()})


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digest): the fingerprint of each document before collisions are looked for."""
    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", wide_hash(canonical(F.col("text"))))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document, as the contract has it."""
    forms = fingerprints(docs)
    rows = with_next(forms.withColumn("tie", F.xxhash64("text")))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    rows = rows.withColumns({"form": canonical(F.col("text")), "edited_form": canonical(F.col("edited"))})
    near_next = F.when(F.col("digest") == F.col("next_digest"), F.col("form") == canonical(F.col("next_text"))).otherwise(F.lit(False))
    out = checkpoint(
        rows.select(
            "doc_id",
            n.cast("bigint").alias("n_chars"),
            F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
            F.col("digest").alias("fingerprint"),
            wide_hash(F.col("edited_form")).alias("edited_fingerprint"),
            (F.col("form") == F.col("edited_form")).cast("double").alias("near_edited"),
            near_next.cast("double").alias("near_next"),
            F.sha2(F.encode("form", "UTF-8"), 256).alias("sha"),
            F.sha2(F.encode("edited_form", "UTF-8"), 256).alias("edited_sha"),
        )
    )
    marked = out.select(F.col("fingerprint").alias("digest"), "sha").union(out.select("edited_fingerprint", "edited_sha"))
    twofold = collided(forms, marked)
    if twofold:
        for name, sha in (("fingerprint", "sha"), ("edited_fingerprint", "edited_sha")):
            out = out.withColumn(name, F.when(F.col(name).isin(twofold), F.concat(name, F.lit("-"), sha)).otherwise(F.col(name)))
    return out.drop("sha", "edited_sha")
