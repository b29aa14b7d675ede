"""Candidate generation: seventeen key channels, one equi-join against bounded posting lists, votes, top k.

Both sides explode their records into (channel, key, position) rows. Targets are ranked within each key in source
order and cut to the channel's bound; queries join on (country, channel, key) and every hit votes. Over-frequent
keys are cut, never dropped, and occurrences count: a word that a record has twice takes two posting slots and
votes twice. Votes are summed in two phases, and the best k targets of each query record are kept, ties by the
first touch in (chunk, channel, position of the key, posting rank).

A record is (entity_id, src, ord, norm_name, norm_address, norm_country); src 1 queries, src 2 and 3 are targets.
Fan-out is bounded on the posting side, so a hot key costs its query rows times at most `MOST_POSTINGS`; the rank
filter sits directly on the window, so Spark limits each key's rows before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import keys
from weftline.sources.tsv import SOURCE_BIT

MOST_POSTINGS = 30


@dataclass(frozen=True)
class BlockingConfig:
    """Bounds as a caller may set them; the smaller of a bound and the channel's own number of hits holds."""

    max_total_candidates: int = 100
    max_token_postings: int = 200
    max_num_word_postings: int = 80
    max_first_word_postings: int = 120
    max_name_postings: int = 200
    max_ngram_postings: int = 30
    max_phonetic_postings: int = 40
    chunk_size: int = 1_500_000


@dataclass(frozen=True)
class Channel:
    number: int
    name: str
    postings: int  # what a key's list holds
    hits: int  # what a query reads of it
    weight: int


GRAMS = 11


def channels(config: BlockingConfig = BlockingConfig()) -> list[Channel]:
    """The channels in the order in which they vote, with bounds and weights as fixed values."""
    c = config
    rows = (
        ("name", c.max_name_postings, 30, 8),
        ("core", c.max_name_postings, 25, 6),
        ("sorted", 20, 15, 4),
        ("first_two", 20, 15, 3),
        ("unspaced", 20, 12, 3),
        ("first_word", c.max_first_word_postings + 1, 10, 2),
        ("last_word", c.max_first_word_postings + 1, 10, 2),
        ("token", c.max_token_postings + 1, 8, 1),
        ("rare_bigram", 20, 12, 3),
        ("phonetic", c.max_phonetic_postings, 12, 3),
        ("gram4", c.max_ngram_postings, 8, 1),
        ("prefix_number", 15, 8, 2),
        ("prefix_street", 15, 8, 2),
        ("two_numbers", 26, 10, 4),
        ("number_word", c.max_num_word_postings + 1, 6, 2),
        ("long_number", 31, 10, 2),
        ("door_pin", 25, 8, 5),
    )
    return [Channel(k + 1, *row) for k, row in enumerate(rows)]


def parsed(records: DataFrame) -> DataFrame:
    """Tokens and numbers of each record, worked out once before any key is made of them."""
    name = F.coalesce("norm_name", F.lit(""))
    chunk = F.col("chunk") if "chunk" in records.columns else F.lit(0)
    out = records.select("entity_id", "src", "ord", chunk.alias("chunk"), F.col("norm_country").alias("country"), name.alias("name"), F.coalesce("norm_address", F.lit("")).alias("address"))
    out = out.withColumns({"core": keys.core_name(F.col("name")), "nums": keys.address_numbers(F.col("address")), "streets": keys.address_words(F.col("address"))})
    return out.withColumns({"words": keys.tokens(F.col("core")), "spaceless": keys.unspaced(F.col("core")), "prefix": F.substring("core", 1, 3)})


def one(value: Column, keep: Column) -> Column:
    """An array of one key, or none."""
    return F.when(keep, F.array(value)).otherwise(F.array().cast("array<string>"))


def word_at(words: Column, place: int) -> Column:
    word = F.get(words, F.lit(place)) if place >= 0 else F.get(words, F.size(words) - 1)
    return one(word, (F.length(word) >= 3) & ~word.isin(*keys.STOPWORDS))


def key_arrays(target: bool) -> list[Column]:
    """The keys of each channel, in channel order, as arrays in the order in which they are asked or filed."""
    name, core, words, nums, streets, prefix = (F.col(c) for c in ("name", "core", "words", "nums", "streets", "prefix"))
    telling = keys.telling(words)
    named = name != ""
    several = F.size(words) > 1
    pins = F.filter(F.slice(nums, 2, F.greatest(F.size(nums), F.lit(1))), lambda n: F.length(n).isin(5, 6))
    pins = F.transform(pins if target else F.slice(pins, 1, 1), lambda n: F.concat_ws("_", nums[0], n))
    sounds = keys.first_sounds(name)
    by_name = [
        one(name, named),
        one(core, (core != name) & (F.length(core) >= 3) if target else core != ""),
        one(F.array_join(F.array_sort(words), " "), several),
        one(F.array_join(F.slice(words, 1, 2), " "), several),
        one(F.col("spaceless"), F.length("spaceless") >= 3),
        word_at(words, 0),
        word_at(keys.legal_free(words), -1),
        telling,
        one(F.array_join(F.slice(telling, 1, 2), "_"), F.size(telling) >= 2),
        one(sounds, sounds != ""),
        F.slice(keys.ngrams(core, 4), 1, 6),
        F.transform(nums, lambda n: F.concat_ws("_", prefix, n)),
        F.transform(F.filter(F.slice(streets, 1, 3), lambda w: F.length(w) >= 4), lambda w: F.concat_ws("_", prefix, w)),
    ]
    none = F.array().cast("array<string>")
    by_address = [
        one(F.array_join(F.slice(nums, 1, 2), "_"), F.size(nums) >= 2),
        F.flatten(F.transform(F.slice(nums, 1, 2), lambda n: F.transform(F.slice(streets, 1, 3), lambda w: F.concat_ws("_", n, w)))),
        F.filter(nums, lambda n: F.length(n) >= 5),
        pins,
    ]
    return [F.when(named, k).otherwise(none) for k in by_name] + by_address


def exploded(records: DataFrame, target: bool, only: tuple[int, ...] | None = None) -> DataFrame:
    """(entity_id, ord, chunk, country, channel, pos, key): one row for each occurrence of a key, of all or some channels."""

    def filed(channel: int, found: Column) -> Column:
        return F.transform(found, lambda x, i: F.struct(F.lit(channel).alias("channel"), i.alias("pos"), x.alias("key")))

    arrays = [filed(n + 1, k) for n, k in enumerate(key_arrays(target)) if only is None or n + 1 in only]
    rows = parsed(records).select("entity_id", "ord", "chunk", "country", F.explode(F.concat(*arrays)).alias("k"))
    return rows.select("entity_id", "ord", "chunk", "country", "k.channel", "k.pos", "k.key")


#: Ranges of a source's order in which its rows are numbered.
RANGES = 1024


def chunked(targets: DataFrame, size: int) -> DataFrame:
    """Add the number of the chunk of `size` targets of a country, in source order, that a target lies in.

    A country's rows are counted by 1,024 ranges of each source's own order, so no country is numbered in one task.
    """
    counts = targets.groupBy("norm_country").count()
    if (counts.agg(F.max("count")).first()[0] or 0) <= size:
        return targets.withColumn("chunk", F.lit(0))
    source = F.shiftright("ord", SOURCE_BIT)
    spans = targets.groupBy(source.alias("source")).agg(F.min("ord").alias("low"), F.max("ord").alias("high"))
    spans = F.broadcast(spans.select("source", "low", F.ceil((F.col("high") - F.col("low") + 1) / RANGES).cast("bigint").alias("step")))
    dealt = targets.withColumn("source", source).join(spans, "source")
    dealt = dealt.withColumn("range", F.col("source") * RANGES + F.floor((F.col("ord") - F.col("low")) / F.col("step"))).drop("source", "low", "step")
    before = Window.partitionBy("norm_country").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("norm_country", "range").count().select("norm_country", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("norm_country", "range").orderBy("ord")) - 1
    return dealt.withColumn("chunk", own).join(starts, ["norm_country", "range"]).withColumn("chunk", F.floor((F.col("start") + F.col("chunk")) / size).cast("int")).drop("range", "start")


def bounds(config: BlockingConfig) -> tuple[Column, Column]:
    """A channel's effective bound and weight."""
    bound, weight = F.lit(0), F.lit(0)
    for c in channels(config):
        bound = F.when(F.col("channel") == c.number, min(c.postings, c.hits)).otherwise(bound)
        weight = F.when(F.col("channel") == c.number, c.weight).otherwise(weight)
    return bound, weight


def postings(targets: DataFrame, config: BlockingConfig = BlockingConfig(), only: tuple[int, ...] | None = None) -> DataFrame:
    """(country, chunk, channel, key, target_id, rk): the first targets of each key, in source order."""
    rows = exploded(chunked(targets, config.chunk_size), True, only)
    bound, _ = bounds(config)
    order = Window.partitionBy("country", "chunk", "channel", "key").orderBy("ord", "pos")
    ranked = rows.withColumn("rk", F.row_number().over(order)).where((F.col("rk") <= MOST_POSTINGS) & (F.col("rk") <= bound))
    return ranked.select("country", "chunk", "channel", "key", F.col("entity_id").alias("target_id"), "rk")


def hits(records: DataFrame, config: BlockingConfig = BlockingConfig(), only: tuple[int, ...] | None = None) -> DataFrame:
    """(s1_id, target_id, chunk, channel, pos, rk, weight): every vote that is cast, of all or some channels."""
    lists = postings(records.where("src <> 1"), config, only)
    queries = exploded(records.where("src = 1"), False, only).select(F.col("entity_id").alias("s1_id"), "country", "channel", "key", "pos")
    _, weight = bounds(config)
    return queries.join(lists, ["country", "channel", "key"]).select("s1_id", "target_id", "chunk", "channel", "pos", "rk", weight.alias("weight"))


def votes(cast: DataFrame) -> DataFrame:
    """(s1_id, target_id, votes, first_touch). Shared 4-grams vote only from two on, and three at most."""
    grams = F.col("channel") == GRAMS
    touch = F.struct("chunk", "channel", "pos", "rk")
    by_chunk = cast.groupBy("s1_id", "target_id", "chunk").agg(
        F.sum(F.when(~grams, F.col("weight"))).alias("plain"),
        F.count_if(grams).alias("grams"),
        F.min(F.when(~grams, touch)).alias("first_plain"),
        F.min(F.when(grams, touch)).alias("first_gram"),
    )
    enough = F.col("grams") >= 2
    scored = by_chunk.select(
        "s1_id",
        "target_id",
        (F.coalesce("plain", F.lit(0)) + F.when(enough, F.least("grams", F.lit(3))).otherwise(F.lit(0))).alias("votes"),
        F.least("first_plain", F.when(enough, F.col("first_gram"))).alias("first_touch"),
    )
    return scored.where("votes > 0").groupBy("s1_id", "target_id").agg(F.sum("votes").alias("votes"), F.min("first_touch").alias("first_touch"))


def candidates(records: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """(s1_id, target_id, votes, rank): the most voted targets of each query record."""
    order = Window.partitionBy("s1_id").orderBy(F.desc("votes"), "first_touch")
    ranked = votes(hits(records, config)).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= config.max_total_candidates).select("s1_id", "target_id", "votes", "rank")


def nested(found: DataFrame, s1: DataFrame) -> DataFrame:
    """(s1_id, candidate_ids): one row for each query record, candidates in rank order, empty where there are none."""
    lists = found.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "target_id"))), lambda x: x["target_id"]).alias("candidate_ids"))
    out = s1.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left")
    return out.select("s1_id", F.coalesce("candidate_ids", F.array().cast("array<string>")).alias("candidate_ids"))


class Blocker:
    """Facade: candidates of a records table under one configuration."""

    def __init__(self, config: BlockingConfig = BlockingConfig()) -> None:
        self.config = config

    def candidates(self, records: DataFrame) -> DataFrame:
        return candidates(records, self.config)
