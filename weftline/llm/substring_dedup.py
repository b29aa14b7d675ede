"""Repeated-phrase automata: remove passages of `WINDOW` words that a document with a smaller doc_id has as well.

1. Documents with equal word sequences are found by SHA-256; all but the smallest doc_id lose every word (if
   they have a window at all) and take no further part.
2. Each remaining document nominates phrases of `PHRASE` words by winnowing (Schleimer et al., 2003): of the
   phrases in each window the one with the least hash. Two documents that share a window nominate the same phrase
   in it, so phrases whose hashes two documents or more nominate are those that recur. The smallest doc_id that
   nominates a phrase brings in its words.
3. Recurring phrases are dealt to shards by the place they come from (document and stretch of nominations), so
   that a passage's phrases stay together; a shard's phrases, about `AUTOMATON`, are one Aho-Corasick automaton.
   Documents are cut into slices, and a slice meets the shards of the hashes that it nominates and no others:
   winnowing makes sure that no window is missed, and the work grows with the text, not with shards times text.
   A hot shard's slices are dealt over copies of its automaton, `SLICES` to a copy.
4. Slices are streamed through the automata, which alone say where a phrase stands: hashes only choose the shards.
   A window whose least phrase was located there is confirmed by 128-bit hashes over all documents: it is removed
   where its smallest doc_id is smaller than the document's. Counts are partial aggregates, and what is hot is
   joined by broadcast: values with a 200,000th of all rows or more are 200,000 at most.

Defined cases: a null or empty text has no words; a very long text is streamed in slices of `SLICE` words;
windows are judged on the input; rows that share a doc_id are not earlier than each other, and each is judged on
its own words; a null doc_id is neither earlier nor later than any other and loses nothing; an empty table gives
no rows; further columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import wordhash
from weftline.llm.common import BATCH_ROWS, BROADCAST_ROWS, HOT, checkpoint, joined_back, map_batches

WINDOW, PHRASE = 50, 16
#: Phrases of one automaton, on average: some 10 MB.
AUTOMATON = 1_000
#: Phrases that one document brings into one shard at most, in a row.
STRETCH = 256
#: Phrase starts of one slice of a text, and slices that a copy of an automaton takes.
SLICE, SLICES = 2_048, 256
#: Odd bases of the hashes of phrases, and of the two of windows.
PHRASE_BASE, BASES = 0xD6E8FEB86659FD93, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def least_phrases(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases, and the place of the least one of each window (the first of equals)."""
    phrases = wordhash.windows(values, PHRASE, PHRASE_BASE)
    if len(values) < WINDOW:
        return phrases, np.empty(0, dtype=np.int64)
    least = np.lib.stride_tricks.sliding_window_view(phrases, WINDOW - PHRASE + 1).argmin(axis=1)
    return phrases, least + np.arange(len(least))


def nominated(values: np.ndarray) -> np.ndarray:
    """Hashes of the phrases that are least in some window, by first place; none for texts shorter than a window."""
    if len(values) < WINDOW:
        return values[:0]
    phrases, least = least_phrases(values)
    found, first = np.unique(phrases[np.unique(least)], return_index=True)
    return found[np.argsort(first)]


def key_of(sha: str) -> int:
    """What tells texts apart among rows that share a doc_id."""
    return int(sha[:15], 16)


def sha_of(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, sha, phrases): each document's words in brief."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, shas, phrases = [], [], []
        for text in batch.column(1).to_pylist():
            words = wordhash.split(text)
            sizes.append(len(words))
            shas.append(sha_of(words))
            phrases.append(nominated(wordhash.hashes(words)).view(np.int64) if len(words) >= WINDOW else np.empty(0, np.int64))
        arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(phrases, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "sha", "phrases"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return map_batches(rows, work, "doc_id bigint, n_words bigint, sha string, phrases array<bigint>")


def laid_out(words: list[bytes]) -> str:
    """Words between single spaces, with a space at either end and a character for each byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def compiled(phrases: list[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in phrases:
        automaton.add_word(phrase)
    automaton.make_automaton()
    return automaton


def located(automaton: ahocorasick.Automaton, words: list[bytes]) -> np.ndarray:
    """For each word whether one of the automaton's phrases starts there."""
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)])
    found = np.zeros(len(starts), dtype=bool)
    hits = np.array([stop - length + 1 for stop, length in automaton.iter(laid_out(words))], dtype=np.int64)
    found[np.searchsorted(starts, hits)] = True
    return found


def dealt(docs: DataFrame, recurring: DataFrame, twice: DataFrame) -> DataFrame:
    """Phrases and slices by shard: (shard, slice, doc_id, key, base, first, body).

    A phrase row (slice null) has phrases in words, by line. A slice's body has the words from `base` on; its own
    phrase starts are the SLICE ones from `first` on, with the words that their windows reach to on either side.
    """
    names = ["shard", "slice", "doc_id", "key", "base", "first", "body"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows: list[tuple] = []
        for doc, key, text, known in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            words = wordhash.split(text)
            phrases, least = least_phrases(wordhash.hashes(words))
            places = np.unique(least)
            known = sorted((k["phrase"], k["shard"], k["own"]) for k in known)
            hashes = np.array([k[0] for k in known], dtype=np.int64)
            wanted = phrases[places].view(np.int64)
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            met, own = set(), {}
            for place, k in zip(places[hashes[at] == wanted].tolist(), at[hashes[at] == wanted].tolist(), strict=True):
                _, shard, brings = known[k]
                met.add((place // SLICE, shard))
                if brings:
                    own.setdefault(shard, set()).add(b" ".join(words[place : place + PHRASE]))
            rows += [(shard, None, None, None, None, None, b"\n".join(sorted(mine))) for shard, mine in sorted(own.items())]
            for part, shard in sorted(met):
                first = part * SLICE
                base = max(0, first - WINDOW + PHRASE)
                rows.append((shard, part, doc, key, base, first, b" ".join(words[base : first + SLICE + WINDOW - 1])))
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows = with_text(docs, recurring, twice).select("doc_id", "key", "text", "phrases")
    return map_batches(rows, work, "shard bigint, slice bigint, doc_id bigint, key bigint, base bigint, first bigint, body binary")


def streamed(rows: DataFrame) -> DataFrame:
    """(doc_id, key, starts, h1, h2): each slice's windows with a least phrase that the automaton of its shard locates."""
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, phrases, automaton = None, [], None
        for whole in batches:
            for cut_at in range(0, whole.num_rows, BATCH_ROWS):
                out: tuple[list, ...] = ([], [], [], [], [])
                for row in whole.slice(cut_at, BATCH_ROWS).to_pylist():
                    if here != (row["shard"], row["copy"]):
                        here, phrases, automaton = (row["shard"], row["copy"]), [], None
                    if row["slice"] is None:
                        phrases += [laid_out([p]) for p in row["body"].split(b"\n")]
                        continue
                    automaton = automaton or compiled(phrases)
                    words = row["body"].split(b" ")
                    found = located(automaton, words)
                    low = row["first"] - row["base"]
                    found[:low] = False
                    found[low + SLICE :] = False
                    values = wordhash.hashes(words)
                    starts = np.flatnonzero(found[least_phrases(values)[1]])
                    if len(starts):
                        hashed = (wordhash.windows(values, WINDOW, base)[starts].view(np.int64) for base in BASES)
                        for column, value in zip(out, (row["doc_id"], row["key"], (starts + row["base"]).astype(np.int32), *hashed), strict=True):
                            column.append(value)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=True)], names=["doc_id", "key", "starts", "h1", "h2"])

    return rows.mapInArrow(run, "doc_id bigint, key bigint, starts array<int>, h1 array<bigint>, h2 array<bigint>")


def windows(docs: DataFrame, recurring: DataFrame, twice: DataFrame) -> DataFrame:
    """The windows of each document whose least phrase recurs; `recurring` has (doc_id, key, phrases: phrase, shard, own)."""
    met = recurring.select(F.explode(F.array_distinct(F.transform("phrases", lambda p: p["shard"]))).alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    hot = checkpoint(met.where(F.col("n") > SLICES).select("shard", F.ceil(F.col("n") / SLICES).alias("copies")))
    rows = dealt(docs, recurring, twice).join(F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot, "shard", "left")
    copies = F.coalesce("copies", F.lit(1))
    one = F.array(F.pmod(F.xxhash64("doc_id", "key", "slice"), copies))
    rows = rows.select("*", F.explode(F.when(F.col("slice").isNull(), F.sequence(F.lit(0).cast("bigint"), copies - 1)).otherwise(one)).alias("copy")).drop("copies")
    return streamed(rows.repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("slice").asc_nulls_first()))


def with_text(docs: DataFrame, rows: DataFrame, twice: DataFrame) -> DataFrame:
    """`rows` (doc_id, key, ...), one for each text, with their words' bytes; the texts of other documents stay put.

    `twice` has the doc_ids that `docs` has more than once: their texts are told apart by key, equal ones taken once.
    """
    ids = rows.select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    if ids.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(ids), "doc_id", "left_semi")
    joined = texts.join(rows.hint("shuffle_hash"), "doc_id")
    if not rows.join(twice, "doc_id", "left_semi").limit(1).count():
        return joined

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([key_of(sha_of(wordhash.split(t))) == k for t, k in zip(texts, keys, strict=True)], pa.bool_()))

    return joined.mapInArrow(same, joined.schema).dropDuplicates(["doc_id", "key"])


def cut(docs: DataFrame, removed: DataFrame, twice: DataFrame) -> DataFrame:
    """(doc_id, key, n_removed, kept): what is left where windows start at `starts`."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, kept = [], []
        for text, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words = wordhash.split(text)
            at = np.array(starts, dtype=np.int64)
            step = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(step, at, 1)
            np.add.at(step, at + WINDOW, -1)
            gone = np.cumsum(step)[:-1] > 0
            counts.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode("utf-8", "replace"))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "key", "n_removed", "kept"])

    return map_batches(with_text(docs, removed, twice).select("doc_id", "key", "text", "starts"), work, "doc_id bigint, key bigint, n_removed bigint, kept string")


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All documents (doc_id, n_words, sha, whole: lost as a whole), (doc_id, key, starts) of repeated windows, and doc_ids of several rows."""
    brief = checkpoint(scan(docs))
    twice = checkpoint(brief.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    first = checkpoint(brief.where(f"n_words >= {WINDOW}").groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    judged = brief.join(F.broadcast(first) if first.count() <= BROADCAST_ROWS else first, "sha", "left")
    judged = judged.withColumn("whole", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    key = F.conv(F.substring("sha", 1, 15), 16, 10).cast("bigint").alias("key")
    singles = judged.where("not whole and doc_id is not null and size(phrases) > 0").select("doc_id", key, "phrases").dropDuplicates(["doc_id", "key"])
    total = brief.agg(F.sum(F.size("phrases"))).first()[0] or 0
    phrases = singles.select("doc_id", "key", F.posexplode("phrases").alias("at", "phrase"))
    source = F.struct("doc_id", F.floor(F.col("at") / STRETCH).cast("int").alias("stretch"))
    shared = phrases.groupBy("phrase").agg(F.min(source).alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).where("low.doc_id < high").select("phrase", "low", "n")
    shared = checkpoint(shared)
    shards = max(1, -(-shared.count() // AUTOMATON))
    known = F.struct("phrase", F.pmod(F.xxhash64("low"), F.lit(shards)).alias("shard"), (F.col("doc_id") == F.col("low.doc_id")).alias("own"))
    recurring = checkpoint(joined_back(phrases.drop("at"), shared, ["phrase"], total, "n", HOT, BROADCAST_ROWS).groupBy("doc_id", "key").agg(F.collect_list(known).alias("phrases")))
    around = checkpoint(windows(docs, recurring, twice))
    total = around.agg(F.sum(F.size("starts"))).first()[0] or 0
    single = around.select("doc_id", "key", F.explode(F.arrays_zip("starts", "h1", "h2")).alias("w")).select("doc_id", "key", F.col("w.starts").alias("start"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    owners = single.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").drop("high")
    later = joined_back(single, owners, ["h1", "h2"], total, "n", HOT, BROADCAST_ROWS).where("doc_id > low").groupBy("doc_id", "key").agg(F.collect_list("start").alias("starts"))
    return judged.select("doc_id", "n_words", "sha", "whole", key), checkpoint(later), twice


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each document."""
    everything, removed, twice = repeats(docs)
    left = cut(docs, removed, twice).select("doc_id", "key", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept"))
    out = everything.join(left, ["doc_id", "key"], "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "doc_id",
        "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("whole"), empty).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
