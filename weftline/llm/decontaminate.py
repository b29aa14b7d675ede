"""Benchmark decontamination: shared-token seeds, greedy string tiling, a threshold on the test's coverage.

1. Seeds are runs of `LEAST_MATCH` words, or a shorter item's whole run. A bit for each seed of the benchmark goes
   into a filter of a fixed `FILTER_BITS`, however large the benchmark is; documents are read once, and those
   without a seed in the filter end there. Documents with equal texts go on as one.
2. The seeds that are left are joined with the items' on the seed itself. Tiles that cover the threshold's share of
   an item hold at least a fifth of as many of its seeds, so pairs of documents and items that share fewer end here.
3. Each pair is tiled: the longest non-overlapping matches are marked, longest first, found by running Karp-Rabin
   with falling search lengths. The share of the item's words that lie in tiles is its coverage, so an item counts
   as leaked even where its passages stand in another order or far apart.

Items reach the tiling by broadcast only where their texts have `ITEM_BYTES` at most and seeds where they were counted
to be few; beyond, the same joins run by shuffle. Matches are followed only from places whose words before them
differ, so a text of one word repeated costs no more than its length times the longest match.

Words are compared by their letters and digits in lower case. Defined cases: null and empty texts match nothing; an
item of fewer than `LEAST_MATCH` words leaks where all its words stand in a row; a very long text is tiled whole, with
those items only whose seeds it holds; of matches of one length the first in the item, then in the document is taken;
items with equal texts are all reported; repeated documents give repeated rows; null ids are carried; empty tables
give no rows; further columns are not carried by `leaks` and kept as they are by `clean`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import wordhash
from weftline.llm.common import BROADCAST_ROWS, attached, checkpoint, fresh, let_go, map_batches

#: Words of a seed and of the shortest tile.
LEAST_MATCH = 5
#: Share of an item's words in tiles from which a document counts as contaminated.
COVERAGE = 0.5
#: Bits of the filter that documents' seeds pass first: 4 MB, in at most half a million rows.
FILTER_BITS = 1 << 25
#: Bytes of benchmark texts that are broadcast to the tiling.
ITEM_BYTES = 32 << 20
#: Search length from which running Karp-Rabin starts.
FIRST_LENGTH = 20
REMEMBERED = 150_000
SEPARATOR = re.compile(r"[\W_]+")
BASE = 0xA0761D6478BD642F


class Hashes(dict):
    """Word as it stands -> a hash of its normal form, 0 where that is empty."""

    def __missing__(self, word: str) -> int:
        plain = SEPARATOR.sub("", word.lower())
        value = (xxhash.xxh3_64_intdigest(plain.encode("utf-8", "replace")) or 1) if plain else 0
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


KNOWN = Hashes()


def forget() -> None:
    KNOWN.clear()


def values_of(text: str | None) -> np.ndarray:
    words = (text or "").split()
    values = np.fromiter(map(KNOWN.__getitem__, words), dtype=np.uint64, count=len(words))
    return values[values != 0]


def maximal(item: np.ndarray, doc: np.ndarray, free_item: np.ndarray, free_doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start in item, start in doc, words) of the matches of `length` free words or more that can't start earlier."""

    def starts(values: np.ndarray, free: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        total = np.concatenate([[0], np.cumsum(free)])
        at = np.flatnonzero(total[length:] - total[: len(total) - length] == length)
        before = np.concatenate([[none], np.where(free, values, none)])[at]
        taken = np.concatenate([np.flatnonzero(~free), [len(values)]])
        room = taken[np.searchsorted(taken, at)] - at
        return at, wordhash.windows(wordhash.mixed(values.astype(np.uint64)), length, BASE)[at], before, room

    none = np.empty(0, dtype=np.int64)
    if min(len(item), len(doc)) < length:
        return none, none, none
    top = int(max(item.max(), doc.max())) + 1
    p, of_p, before_p, room_p = starts(item, free_item, top)
    at, of_at, before_at, room_at = starts(doc, free_doc, top + 1)
    hashes = np.unique(of_p)
    place = np.minimum(np.searchsorted(hashes, of_at), max(0, len(hashes) - 1))
    hit = hashes[place] == of_at if len(hashes) else np.zeros(len(at), dtype=bool)
    at, before_at, room_at, place = at[hit], before_at[hit], room_at[hit], place[hit]
    key = np.searchsorted(hashes, of_p) * (top + 2) + before_p
    order = np.argsort(key, kind="stable")
    p, key, room_p = p[order], key[order], room_p[order]
    low, high = np.searchsorted(key, place * (top + 2)), np.searchsorted(key, (place + 1) * (top + 2))
    skip, resume = (np.searchsorted(key, place * (top + 2) + before_at, side=s) for s in ("left", "right"))
    sizes = (high - low) - (resume - skip)
    pair = np.repeat(np.arange(len(at)), sizes)
    step = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[pair]
    step += np.where(step >= skip[pair], (resume - skip)[pair], 0)
    p, at, bound = p[step], at[pair], np.minimum(room_p[step], room_at[pair])
    n = np.zeros(len(p), dtype=np.int64)
    active, k = np.arange(len(p)), 0
    while len(active := active[bound[active] > k]):
        active = active[item[p[active] + k] == doc[at[active] + k]]
        k += 1
        n[active] = k
    return p[n >= length], at[n >= length], n[n >= length]


def tiles(item: list[int] | np.ndarray, doc: list[int] | np.ndarray, least: int = LEAST_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling (Wise, 1993): (start in item, start in doc, length), longest first.

    Values of 0 or less match nothing. Equal lengths are taken by their start in the item, then in the document.
    """
    item, doc = np.asarray(item, dtype=np.int64), np.asarray(doc, dtype=np.int64)
    free_item, free_doc, found = item > 0, doc > 0, []
    length = max(least, min(FIRST_LENGTH, len(item)))
    while True:
        p, at, n = maximal(item, doc, free_item, free_doc, length)
        if not len(n):
            if length == least:
                return found
            length = max(least, length // 2)
            continue
        longest = int(n.max())
        top = n == longest
        for a, b in sorted(zip(p[top].tolist(), at[top].tolist(), strict=True)):
            if free_item[a] and free_doc[b] and free_item[a : a + longest].all() and free_doc[b : b + longest].all():
                free_item[a : a + longest] = False
                free_doc[b : b + longest] = False
                found.append((a, b, longest))


def covered(item: np.ndarray, doc: np.ndarray) -> tuple[int, int]:
    """Tiles and covered words of an item in a document, both as values of words."""
    words, own = np.unique(item, return_inverse=True)
    place = np.minimum(np.searchsorted(words, doc), len(words) - 1)
    found = tiles(own + 1, np.where(words[place] == doc, place + 1, 0), min(LEAST_MATCH, len(item)))
    return len(found), sum(n for *_, n in found)


def digest(text: str) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit("text"), text)]


def item_seeds(items: DataFrame, coverage: float) -> DataFrame:
    """(i1, i2, seed, times, need, words): each item's seeds; `need` of them are in a document that covers enough."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    names = ["i1", "i2", "seed", "times", "need", "words"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        columns: tuple[list, ...] = ([], [], [], [], [], [])
        for i1, i2, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            values = values_of(text)
            if len(values):
                seeds, times = np.unique(wordhash.runs(values, min(LEAST_MATCH, len(values))).view(np.int64), return_counts=True)
                need = math.ceil(coverage * len(values) / LEAST_MATCH)
                for column, value in zip(columns, ([i1] * len(seeds), [i2] * len(seeds), seeds.tolist(), times.tolist(), [need] * len(seeds), [len(values)] * len(seeds)), strict=True):
                    column += value
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names) if columns[0] else None

    return map_batches(items.select("i1", "i2", "text"), work, "i1 bigint, i2 bigint, seed bigint, times int, need int, words int", done=forget)


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bit for each seed, by its highest bits; at most FILTER_BITS / 64 rows reach the driver."""
    bits = FILTER_BITS.bit_length() - 1
    at = F.shiftrightunsigned("seed", 64 - bits)
    rows = seeds.groupBy(F.shiftright(at, 6).alias("k")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - bits}) & 63 as int))")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for r in rows:
        out[r["k"]] = r["bits"]
    return out.view(np.uint64)


def candidates(docs: DataFrame, held: np.ndarray, lengths: list[int]) -> DataFrame:
    """(d1, d2, text, seeds) of each distinct text with seeds in the filter, by runs of `lengths` words."""
    shared = docs.sparkSession.sparkContext.broadcast(held)
    shift = np.uint64(64 - (FILTER_BITS.bit_length() - 1))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        bits, kept, seeds = shared.value, [], []
        for k, text in enumerate(batch.column(2).to_pylist()):
            values = values_of(text)
            own = np.concatenate([wordhash.runs(values, n) for n in lengths])
            at = own >> shift
            own = np.unique(own[(bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1])
            if len(own):
                kept.append(k)
                seeds.append(own.view(np.int64))
        if not kept:
            return None
        rows = batch.take(pa.array(kept))
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(seeds, pa.list_(pa.int64()))], names=["d1", "d2", "text", "seeds"])

    d1, d2 = digest("text")
    rows = docs.select(d1.alias("d1"), d2.alias("d2"), "text")
    return map_batches(rows, work, "d1 bigint, d2 bigint, text string, seeds array<bigint>", done=forget).dropDuplicates(["d1", "d2"])


def tiled(pairs: DataFrame, coverage: float) -> DataFrame:
    """(d1, d2, i1, i2, n_tiles, n_covered, n_item_words, coverage) of the pairs that reach the threshold."""
    names = ["d1", "d2", "i1", "i2", "n_tiles", "n_covered", "n_item_words", "coverage"]
    kinds = (*[pa.int64()] * 4, *[pa.int32()] * 3, pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] | None = None
        for batch in batches:
            rows = []
            for *key, text, item in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if last is None or last[0] != text:
                    last = (text, values_of(text))
                own = values_of(item)
                n, words = covered(own, last[1])
                if words >= coverage * len(own):
                    rows.append((*key, n, words, len(own), words / len(own)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        forget()
        let_go()

    schema = "d1 bigint, d2 bigint, i1 bigint, i2 bigint, n_tiles int, n_covered int, n_item_words int, coverage double"
    return pairs.select("d1", "d2", "i1", "i2", "text", "item").mapInArrow(run, schema)


def leaked_texts(docs: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """`tiled` over all distinct texts of `docs` and distinct items with keys (i1, i2) and text."""
    items = items.dropDuplicates(["i1", "i2"])
    seeds = checkpoint(item_seeds(items, coverage))
    lengths = sorted({LEAST_MATCH, *(r[0] for r in seeds.where(F.col("words") < LEAST_MATCH).select("words").distinct().collect())})  # LEAST_MATCH at most
    found = checkpoint(candidates(docs, seed_filter(seeds), lengths))
    met = attached(found.select("d1", "d2", F.explode("seeds").alias("seed")), seeds, ["seed"])
    pairs = met.groupBy("d1", "d2", "i1", "i2").agg(F.sum("times").alias("met"), F.first("need").alias("need")).where("met >= need")
    small = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= ITEM_BYTES and seeds.count() <= BROADCAST_ROWS
    texts = items.select("i1", "i2", F.col("text").alias("item"))
    pairs = pairs.select("d1", "d2", "i1", "i2").join(found.select("d1", "d2", "text"), ["d1", "d2"]).join(F.broadcast(texts) if small else texts, ["i1", "i2"])
    return checkpoint(tiled(pairs, coverage))


def keyed(items: DataFrame) -> DataFrame:
    i1, i2 = digest("text")
    return items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"), i1.alias("i1"), i2.alias("i2"))


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_tiles, n_covered, n_item_words, coverage) of each pair from the threshold on."""
    items = keyed(items)
    found = attached(leaked_texts(docs, items, coverage), items.select("item_id", "i1", "i2"), ["i1", "i2"])
    d1, d2 = digest("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), d1.alias("d1"), d2.alias("d2"))
    return attached(rows, found, ["d1", "d2"]).select("doc_id", "item_id", "n_tiles", "n_covered", "n_item_words", "coverage")


def clean(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, text: str = "text") -> DataFrame:
    """`docs` without those that hold an item up to the threshold or beyond; rows and columns stay as they are."""
    one, two = fresh("d1"), fresh("d2")
    found = leaked_texts(docs.select(F.col(text).alias("text")), keyed(items), coverage)
    bad = checkpoint(found.select(F.col("d1").alias(one), F.col("d2").alias(two)).distinct())
    rows = docs.withColumns(dict(zip((one, two), digest(text), strict=True)))
    return attached(rows, bad, [one, two], "left_anti").select(docs.columns)
