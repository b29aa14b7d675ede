"""Best-fit packing: plan over the histogram of lengths, then deal documents to the planned slots by rank.

Documents are tokenised on the executors, cut where they are longer than a sequence, and reduced to rows of
(document, piece, length). Only the histogram, at most one row per length up to the capacity, reaches the
driver; best-fit decreasing runs over its counts, so planning costs the same for a thousand documents or for a
trillion. The plan says: the pieces of length L with rank r in [from, from + n) lie in sequences first,
first + 1, ... at one offset. Pieces take their slots by joining on length and rank.

Defined cases: a null text is empty, and an empty document still has its final id 0; repeated rows are packed
each for itself; an empty table gives no rows; further input columns are not carried.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import checkpoint, map_batches, ranked

CAPACITY = 2048
#: Parts of words whose ids a worker remembers, about 200 bytes each, and half as many that it has met once.
REMEMBERED = 250_000
#: Text that is looked up at a time; a longer text alone.
GROUP_BYTES, GROUP_ROWS = 1 << 21, 1 << 14
#: Kinds of bytes in words. Plain words have ASCII letters, digits and punctuation, but for what may begin a contraction
#: or a special token, and letters from U+00C0 to U+00FF: each is lowered by itself, and no two of them compose.
ODD, LETTER, DIGIT, SIGN = range(4)
KIND, LOWER = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
KIND[33:127] = SIGN
KIND[[ord(c) for c in "'<"]] = ODD
KIND[48:58] = DIGIT
KIND[65:91] = KIND[97:123] = LETTER
LOWER[65:91] += 32
PART = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[!-&(-/:;=-@\\[-`{-~]+")
#: What a tokenizer does before its merges where words are parted here.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: How byte-level vocabularies write the 256 bytes: those that are no visible characters by further ones.
VISIBLE = [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else "" for b in range(256)]
VISIBLE = "".join(c or chr(256 + VISIBLE[:b].count("")) for b, c in enumerate(VISIBLE))
#: Ranks that one task numbers at a time.
RANKS_A_TASK = 50_000
SEQUENCE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def parted(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words' parts, as the tokenizer lowers and parts them, and each word's first part, the number of all at the end.

    A word that isn't plain is one part, unchanged: lowering it first would change which marks compose and what is a
    special token.
    """
    words = words.cast(pa.string())
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    kind, low = KIND[raw], LOWER[raw]
    second = np.flatnonzero(raw == 0xC3) + 1
    second = second[(raw[second] != 0x97) & (raw[second] != 0xB7)]  # the signs of multiplication and division
    kind[second - 1] = kind[second] = LETTER
    low[second[raw[second] < 0x9F]] |= 0x20  # from U+00DF on they are small
    odd = np.diff(np.concatenate(([0], np.cumsum(kind == ODD)))[offsets]) > 0
    inside = np.repeat(odd, np.diff(offsets))
    starts = kind == DIGIT
    starts[1:] |= kind[1:] != kind[:-1]
    starts &= ~inside
    starts[offsets[:-1][np.diff(offsets) > 0]] = True
    cuts = np.append(np.flatnonzero(starts), len(raw)).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.where(inside, raw, low)))
    return parts, np.concatenate(([0], np.cumsum(starts)))[offsets]


def gathered(values: np.ndarray, ends: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values that end at `ends`, in an order that may repeat them, and where they end then."""
    sizes = np.diff(ends, prepend=0)
    n = sizes[order]
    to = np.cumsum(n)
    at = np.repeat((ends - sizes)[order] - to + n, n)
    at += np.arange(len(at))
    return values[at], to


class WordIds(dict):
    """Part of a word, or a word that is not parted -> its ids as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids in order. Words
    are cut and told apart in batches; a distinct part asks for the tokenizer's merges alone, any other word for the
    whole tokenizer. What is looked up is remembered from its second time on, so the many that come once don't
    drive out the others.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        steps = [json.loads(step.__getstate__()) if step else None for step in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.parts = steps == [NORMALIZER, PRE_TOKENIZER] and all("<" in token.content for token in added)
        self.once: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.once.pop(word, None)
        if ids is not None:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
            return ids
        if self.parts and PART.fullmatch(word):
            found = [token.id for token in self.merges.tokenize(charmap_decode(word.encode(), "strict", VISIBLE)[0])]
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) <= 64:
            if len(self.once) >= REMEMBERED // 2:
                self.once.clear()
            self.once[word] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.once.clear()

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with its final 0, and where each text's ids end."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        parts, first = parted(words.dictionary) if self.parts else (words.dictionary, np.arange(len(words.dictionary) + 1))
        parts = parts.dictionary_encode()
        found = list(map(self.__getitem__, parts.dictionary.to_numpy(zero_copy_only=False).tolist()))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // 4
        ids, ends = gathered(np.frombuffer(b"".join(found), "<u4"), ends, parts.indices.to_numpy())
        ends = np.concatenate(([0], ends))[first[1:]]
        last = split.offsets.to_numpy()[1:]
        order = np.insert(words.indices.to_numpy(), last, len(ends))  # the final id 0 as one more word
        ids, ends = gathered(np.append(ids, np.uint32(0)), np.append(ends, len(ids) + 1), order)
        return ids, ends[last + np.arange(len(last))]

    def encode(self, text: str) -> bytes:
        return self.of(pa.array([text], pa.string()))[0].tobytes()


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One tokenizer for all tasks of a worker; words are remembered for one task."""
    return WordIds(path)


def groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of neighbouring rows that hold GROUP_BYTES together, or of one longer row."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // GROUP_BYTES)) + 1
    for first, end in pairwise([0, *cuts.tolist(), len(texts)]):
        yield first, end - first


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids, cut at multiples of the capacity."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        memory, rows, (docs, texts) = word_ids(tokenizer_path), ([], [], [], [], []), batch.columns
        for first, n in groups(texts):
            ids, ends = memory.of(texts.slice(first, n))
            at = 0
            for doc, end in zip(docs.slice(first, n).to_pylist(), ends.tolist(), strict=True):
                for k, start in enumerate(range(at, end, capacity)):
                    part = ids[start : min(start + capacity, end)]
                    for column, value in zip(rows, (doc, k, start - at, len(part), zlib.crc32(part)), strict=True):
                        column.append(value)
                at = end
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, SEQUENCE_SCHEMA, done=lambda: word_ids(tokenizer_path).forget(), rows=GROUP_ROWS)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, number, first sequence, offset).

    Open sequences are kept as runs of neighbours with equal room. A step moves whole runs and splits one at
    most, so there are never more than about three runs for each length, whatever the counts are.
    """
    rooms: list[int] = []  # sorted, those that have open sequences
    runs: dict[int, list[tuple[int, int]]] = {}
    slots, opened = [], 0

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            if not runs.setdefault(room, []):
                insort(rooms, room)
            runs[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, n = runs[room].pop()
                if not runs[room]:
                    del rooms[k]
                layers = room // length  # best fit fills a sequence before it takes the next of the same room
                taken = min(n, left // layers) or 1
                layers = min(layers, left)
                slots += [(length, rank + k * taken, taken, first, capacity - room + k * length) for k in range(layers)]
                keep(room, first + taken, n - taken)
                keep(room - layers * length, first, taken)
                taken *= layers
            else:  # as many full new sequences as this length makes, or one for what is left of it
                layers = capacity // length
                n = left // layers or 1
                layers = min(layers, left)
                slots += [(length, rank + k * n, n, opened, k * length) for k in range(layers)]
                keep(capacity - layers * length, opened, n)
                opened, taken = opened + n, layers * n
            rank, left = rank + taken, left - taken
    return slots


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows of `pieces` with sequence_id and offset."""
    cut = checkpoint(pieces(docs, tokenizer_path, capacity))
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    slots = cut.sparkSession.createDataFrame(plan(histogram, capacity), "length bigint, from bigint, n bigint, first bigint, offset bigint")
    buckets = max(4, -(-max(histogram.values(), default=1) // RANKS_A_TASK))
    rank = ranked(cut, ["length"], ["doc_id", "piece"], "rank", buckets)
    placed = rank.join(F.broadcast(slots), "length").where("rank >= `from` and rank < `from` + n")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank") - F.col("from")).alias("sequence_id"), "offset")
