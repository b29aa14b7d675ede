from __future__ import annotations

import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftline.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text: str) -> list[int]:
    return [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcXYZ é́ΣİßǅÅ½9,.;:!'|*\n\t\x1c\x1f\x85\xa0 <|>&"), st.characters(codec="utf-8")), max_size=60))
def test_words_give_the_tokenizers_ids(tokenizer, text):
    ids = p.word_ids(PATH).encode(text)
    assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == whole(tokenizer, text)


def test_special_strings_and_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(p, "REMEMBERED", 3)
    words = p.WordIds(PATH)
    for text in ("a b c d e f, g. h a b", "<|endoftext|> x<|startoftext|>y IT'S don't!! ''s,", "x" * 500):
        ids = words.encode(text)
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == whole(tokenizer, text)
    assert len(words) <= 3


@pytest.mark.parametrize("text", ["H\u0331 T\u0308.", "j\u030c", "<|ENDOFTEXT|> <|EndOfText|>x", "", " ", " a\x0b\x0cb\x1fc\x85d\u2003e ", "\U0001f600\ufb01 ' '' 's'T'Re'xs' 12a3 --<--|>"])
def test_marks_and_special_tokens_are_left_to_the_tokenizer(tokenizer, text):
    ids = p.word_ids(PATH).encode(text)
    assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == whole(tokenizer, text)


def test_every_latin_character(tokenizer):
    text = " ".join(f"{c} x{c}Y {c}{c}7 .{c}'s" for c in map(chr, range(0x21, 0x250)))
    ids = p.word_ids(PATH).encode(text)
    assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == whole(tokenizer, text)


def test_plain_words_ask_for_their_distinct_parts_merges_alone(tokenizer):
    class Merges:
        def __init__(self):
            self.asked, self.tokenize = [], lambda part: self.asked.append(part) or tokenizer.model.tokenize(part)

    words = p.WordIds(PATH)
    assert words.parts
    words.tokenizer, words.merges = None, Merges()
    texts = ["Plain, PLAIN words; plain42!", None, "\u00c9t\u00e9 (words)"]
    ids, ends = words.of(pa.array(texts))
    assert ids.tolist() == [i for text in texts for i in whole(tokenizer, text or "")]
    assert ends.tolist() == [len(ids[:e]) for e in ends] and len(ends) == 3
    assert len(words.merges.asked) == len(set(words.merges.asked)) == 10  # plain , words ; 4 2 ! ( ) and one with accents


def test_groups_of_rows(monkeypatch):
    monkeypatch.setattr(p, "GROUP_BYTES", 10)
    texts = ["four", None, "five5", "x" * 35, "", "four", "four"]
    found = list(p.groups(pa.array(texts)))
    assert [first for first, _ in found] == [sum(n for _, n in found[:k]) for k in range(len(found))] and sum(n for _, n in found) == len(texts)
    assert all(sum(len(t or "") for t in texts[first + 1 : first + n]) < 10 for first, n in found)


def test_workers_forget_the_words_of_a_task(spark):
    class Docs:  # gives the function of a task itself
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words of a task", "words of a task"]})
    assert sum(out.num_rows for out in p.pieces(Docs(), PATH)(iter([batch]))) == 2
    assert not p.word_ids(PATH) and not p.word_ids(PATH).once


def test_best_fit_fills_a_sequence_before_the_next():
    slots = p.plan({7: 50, 38: 4, 13: 4}, 64)
    assert max(first + n for _, _, n, first, _ in slots) == 9


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=12))
def test_plan(histogram):
    used, ranks = defaultdict(dict), defaultdict(int)
    for length, first_rank, n, first, offset in p.plan(histogram, 64):
        assert first_rank == ranks[length]
        ranks[length] += n
        for k in range(n):
            assert offset not in used[first + k]
            used[first + k][offset] = length
    assert dict(ranks) == histogram
    for slots in used.values():
        at = 0
        for offset in sorted(slots):
            assert offset == at
            at += slots[offset]
        assert at <= 64
    rooms = []  # one item at a time into the fullest sequence that takes it
    for length in sorted((k for k, v in histogram.items() for _ in range(v)), reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else 64) - length)
    assert len(used) <= len(rooms)


def test_pack(documents, tokenizer, prose_of):
    texts = ["hello world", None, "", "hello world", prose_of(1, 3000), "tail."] + [prose_of(k, 5 + 7 * k) for k in range(40)]
    docs = documents(texts, extra=True)
    rows = p.pack(docs, PATH).collect()
    pieces = defaultdict(dict)
    for r in rows:
        pieces[r.doc_id][r.piece] = r
    for k, text in enumerate(texts):
        ids = whole(tokenizer, text or "")
        assert sorted(pieces[k]) == list(range(-(-len(ids) // p.CAPACITY)))
        for n, r in pieces[k].items():
            part = ids[n * p.CAPACITY : (n + 1) * p.CAPACITY]
            assert (r.start, r.length, r.ids_crc32) == (n * p.CAPACITY, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
    slots = defaultdict(list)
    for r in rows:
        slots[r.sequence_id].append((r.offset, r.length))
    for s in slots.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= p.CAPACITY
    assert len(slots) <= 1 + -(-sum(r.length for r in rows) // p.CAPACITY)
    assert p.pack(docs.limit(0), PATH).count() == 0
    assert p.pack(documents([(1, "a"), (1, "a")]), PATH).count() == 2
