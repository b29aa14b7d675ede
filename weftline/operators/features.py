"""Pair features: profiles of records, worked out once each, joined to candidate pairs.

Set and number features are Catalyst expressions; Indel, partial and Jaro-Winkler similarities of a batch of pairs
come from one Arrow function that returns them all together. Feature columns and their order are a contract.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weftline.functions import keys, similarity
from weftline.functions.text import numbers

# The features in the order in which models take them.
FEATURE_COLUMNS = (
    "name_exact name_ratio name_partial name_token_sort name_token_set name_jw"
    " name_word_jaccard name_token_overlap_count name_ngram_jaccard name_4gram_jaccard"
    " first_word_match last_word_match name_len_diff name_len_ratio"
    " name_containment_s1 name_containment_t name_word_count_ratio name_phonetic_sim"
    " addr_exact addr_ratio addr_partial addr_token_sort addr_token_set addr_jw"
    " addr_word_jaccard geo_jaccard has_common_geo contradictory_geo"
    " geo_overlap_count geo_overlap_ratio addr_first_num_match"
    " addr_num_jaccard addr_num_overlap_count"
    " strong_name_weak_addr weak_name_strong_addr strong_both phonetic_strong_lex_weak"
    " name_max_sim addr_max_sim combined_max full_token_set full_jw"
    " s1_missing_addr t_missing_addr both_missing_addr"
    " country_match is_source2 is_source3 country_id"
).split()

STRINGS = ("name", "addr", "sorted_name", "sorted_addr", "full")
SETS = ("words", "addr_words", "sounds", "full_words")
#: The strings that decide similarities, and the sets that are made of each.
PARTS = {"name": {"name_token_set": "words", "name_phonetic_sim": "sounds"}, "addr": {"addr_token_set": "addr_words"}, "full": {"full_token_set": "full_words"}}
SIMILARITIES = ("name_ratio", "name_partial", "name_token_sort", "name_jw", "addr_ratio", "addr_partial", "addr_token_sort", "addr_jw", "full_jw", "name_token_set", "addr_token_set", "name_phonetic_sim", "full_token_set")


def profiles(records: DataFrame) -> DataFrame:
    """One row for each record with everything that its pairs need; materialise it before a join with many pairs."""
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("norm_name", "norm_address", "norm_country")]
    rows = records.select("entity_id", *blank, "business_address")
    name, addr = F.col("norm_name"), F.col("norm_address")
    all_numbers = F.transform(F.regexp_extract_all(addr, F.lit(r"(\d+)"), F.lit(1)), lambda x: F.ltrim(x, F.lit("0")))
    words = keys.tokens(name)
    full = F.concat_ws(" ", name, addr)
    country_id = F.when(F.col("norm_country") == "india", 0.0).when(F.col("norm_country") == "us", 1.0).when(F.col("norm_country") == "france", 2.0)
    return rows.select(
        "entity_id",
        name.alias("name"),
        addr.alias("addr"),
        F.col("norm_country").alias("country"),
        F.array_distinct(words).alias("words"),
        F.array_distinct(keys.ngrams(name, 3)).alias("grams3"),
        F.array_distinct(keys.ngrams(name, 4)).alias("grams4"),
        F.coalesce(F.get(words, F.lit(0)), F.lit("")).alias("first_word"),
        F.element_at(F.concat(F.array(F.lit("")), keys.legal_free(words)), -1).alias("last_word"),
        F.array_distinct(F.filter(F.split(keys.first_sounds(name, keys.metaphone, " "), " "), lambda w: w != "")).alias("sounds"),
        F.array_distinct(keys.tokens(addr)).alias("addr_words"),
        numbers(F.col("business_address")).alias("geos"),
        F.coalesce(F.get(all_numbers, F.lit(0)), F.lit("")).alias("first_number"),
        F.array_distinct(F.filter(all_numbers, lambda x: x != "")).alias("number_set"),
        keys.sorted_tokens(name).alias("sorted_name"),
        keys.sorted_tokens(addr).alias("sorted_addr"),
        full.alias("full"),
        F.array_distinct(keys.tokens(full)).alias("full_words"),
        F.coalesce(country_id, F.lit(-1.0)).alias("country_id"),
        F.startswith("entity_id", F.lit("S2-")).cast("double").alias("is_s2"),
        F.startswith("entity_id", F.lit("S3-")).cast("double").alias("is_s3"),
    )


@F.pandas_udf(StructType([StructField(n, DoubleType()) for n in SIMILARITIES]))
def _similarities(pairs: pd.DataFrame) -> pd.DataFrame:
    out = {}
    for part, sets in PARTS.items():  # what follows from the same two strings is worked out once a batch
        (left, lefts), (right, rights) = (pd.factorize(pairs[f"{side}_{part}"]) for side in ("l", "r"))
        _, first, again = np.unique(left * max(len(rights), 1) + right, return_index=True, return_inverse=True)
        rows = pairs.iloc[first]

        def text(c: str, rows: pd.DataFrame = rows) -> tuple[list[str], list[str]]:
            return rows[f"l_{c}"].tolist(), rows[f"r_{c}"].tolist()

        found = {f"{part}_jw": similarity.jaro_winkler(*text(part))}
        if part != "full":
            found[f"{part}_ratio"] = similarity.ratio(*text(part))
            found[f"{part}_partial"] = similarity.partial_ratio(*text(part))
            found[f"{part}_token_sort"] = similarity.ratio(*text(f"sorted_{part}"))
        for name, words in sets.items():
            found[name] = similarity.set_ratio(rows[f"n_{words}"].to_numpy(), *text(f"only_{words}"), rows[f"e_{words}"].to_numpy())
        out |= {k: v[again] for k, v in found.items()}
    return pd.DataFrame(out)[list(SIMILARITIES)]


def both(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def share(part: Column, whole: Column, empty: float) -> Column:
    return F.when(whole > 0, part / F.greatest(whole, F.lit(1))).otherwise(F.lit(empty))


def pair_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """(s1_id, target_id, FEATURE_COLUMNS) of each pair whose two records are known; further columns of pairs follow."""
    known = profiles(records)
    left = known.select([F.col(c).alias(f"l_{c}") for c in known.columns])
    right = known.select([F.col(c).alias(f"r_{c}") for c in known.columns])
    rest = [c for c in pairs.columns if c not in ("s1_id", "target_id")]
    joined = pairs.join(left, F.col("s1_id") == F.col("l_entity_id")).join(right, F.col("target_id") == F.col("r_entity_id"))
    sent = {f"{side}_{c}": F.col(f"{side}_{c}") for c in STRINGS for side in ("l", "r")}
    for c in SETS:
        parts = similarity.token_sets(F.col(f"l_{c}"), F.col(f"r_{c}"))
        sent |= dict(zip((f"n_{c}", f"l_only_{c}", f"r_only_{c}", f"e_{c}"), parts, strict=True))
    joined = joined.withColumn("sim", _similarities(F.struct(*(v.alias(k) for k, v in sent.items()))))

    def pair(c: str) -> tuple[Column, Column]:
        return F.col(f"l_{c}"), F.col(f"r_{c}")

    def common(c: str) -> Column:
        return F.size(F.array_intersect(*pair(c)))

    def equal(c: str) -> Column:
        a, b = pair(c)
        return both((a == b) & (a != ""))

    length = [F.length(c) for c in pair("name")]
    count = [F.size(c) for c in pair("words")]
    geo = [F.size(c) for c in pair("geos")]
    either_geo = geo[0] + geo[1] - common("geos")
    missing = [c == "" for c in pair("addr")]
    plain = {
        "name_exact": equal("name"),
        "name_word_jaccard": keys.jaccard(*pair("words")),
        "name_token_overlap_count": common("words").cast("double"),
        "name_ngram_jaccard": keys.jaccard(*pair("grams3")),
        "name_4gram_jaccard": keys.jaccard(*pair("grams4")),
        "first_word_match": equal("first_word"),
        "last_word_match": equal("last_word"),
        "name_len_diff": F.abs(length[0] - length[1]).cast("double"),
        "name_len_ratio": share(F.least(*length), F.greatest(*length), 1.0),
        "name_containment_s1": common("words") / F.greatest(count[0], F.lit(1)),
        "name_containment_t": common("words") / F.greatest(count[1], F.lit(1)),
        "name_word_count_ratio": share(F.least(*count), F.greatest(*count), 1.0),
        "addr_exact": equal("addr"),
        "addr_word_jaccard": keys.jaccard(*pair("addr_words")),
        "geo_jaccard": keys.jaccard(*pair("geos")),
        "has_common_geo": both(common("geos") > 0),
        "contradictory_geo": both((geo[0] > 0) & (geo[1] > 0) & (common("geos") == 0)),
        "geo_overlap_count": common("geos").cast("double"),
        "geo_overlap_ratio": common("geos") / F.greatest(either_geo, F.lit(1)),
        "addr_first_num_match": equal("first_number"),
        "addr_num_jaccard": keys.jaccard(*pair("number_set")),
        "addr_num_overlap_count": common("number_set").cast("double"),
        "s1_missing_addr": both(missing[0]),
        "t_missing_addr": both(missing[1]),
        "both_missing_addr": both(missing[0] & missing[1]),
        "country_match": both(F.col("l_country") == F.col("r_country")),
        "is_source2": F.col("r_is_s2"),
        "is_source3": F.col("r_is_s3"),
        "country_id": F.col("l_country_id"),
    }
    staged = joined.select("s1_id", "target_id", *rest, *(v.alias(k) for k, v in plain.items()), "sim.*")
    return staged.withColumns(interactions()).select("s1_id", "target_id", *FEATURE_COLUMNS, *rest)


def interactions() -> dict[str, Column]:
    """Features of features; the cut-offs are fixed values."""
    name, addr, sound = F.col("name_token_set"), F.col("addr_token_set"), F.col("name_phonetic_sim")
    name_max = F.greatest("name_ratio", "name_token_sort", "name_token_set", "name_jw", "name_phonetic_sim")
    addr_max = F.greatest("addr_ratio", "addr_token_sort", "addr_token_set", "addr_jw")
    return {
        "strong_name_weak_addr": both((name >= 0.85) & (addr < 0.50)),
        "weak_name_strong_addr": both((name < 0.60) & (addr >= 0.80)),
        "strong_both": both((name >= 0.80) & (addr >= 0.80)),
        "phonetic_strong_lex_weak": both((sound >= 0.75) & (name < 0.60)),
        "name_max_sim": name_max,
        "addr_max_sim": addr_max,
        "combined_max": name_max * 0.6 + addr_max * 0.4,
    }
