from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm import decontaminate as c

SCHEMA = "item_id bigint, text string, n_tiles string"


def tiles_by_hand(item, doc, least):
    """Greedy string tiling by looking at every pair of places in every round."""
    taken_item, taken_doc, found = set(), set(), []
    while True:
        best = []
        for p in range(len(item)):
            for at in range(len(doc)):
                n = 0
                while p + n < len(item) and at + n < len(doc) and item[p + n] == doc[at + n] > 0 and p + n not in taken_item and at + n not in taken_doc:
                    n += 1
                if n >= least:
                    best.append((-n, p, at))
        if not best:
            return found
        for n, p, at in sorted(best):
            if n == min(best)[0] and not (taken_item & set(range(p, p - n)) or taken_doc & set(range(at, at - n))):
                taken_item |= set(range(p, p - n))
                taken_doc |= set(range(at, at - n))
                found.append((p, at, -n))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(-1, 3), max_size=40))
def test_tiles_cover_what_the_plain_algorithm_covers(item, doc):
    got, want = c.tiles(item, doc, 2), tiles_by_hand(item, doc, 2)
    for p, at, n in got:
        assert item[p : p + n] == doc[at : at + n] and n >= 2
    assert len({k for p, _, n in got for k in range(p, p + n)}) == sum(n for *_, n in got) == len({k for _, at, n in got for k in range(at, at + n)})
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=40), st.lists(st.integers(0, 12), max_size=80), st.integers(1, 5))
def test_coverage_against_the_plain_algorithm(item, doc, least):
    assert c.tiles(item, doc, least) == tiles_by_hand(item, doc, least)


def leaks_by_hand(docs, items, coverage=c.COVERAGE):
    """Every document against every item, without seeds."""
    def plain(text):
        return [w for w in (c.SEPARATOR.sub("", x.lower()) for x in (text or "").split()) if w]

    found = {}
    for i, text in items:
        own = plain(text)
        number = {w: k + 1 for k, w in enumerate(dict.fromkeys(own))}
        for d, body in docs:
            tiled = tiles_by_hand([number[w] for w in own], [number.get(w, 0) for w in plain(body)], min(5, len(own))) if own else []
            words = sum(n for *_, n in tiled)
            if own and words >= coverage * len(own):
                found[d, i] = (len(tiled), words, len(own))
    return found


def test_leaks_against_every_pair(spark, documents, prose_of):
    rng = random.Random(3)
    items = [(k, prose_of(k, 8 + k, 40)) for k in range(14)] + [(20, "one two"), (21, "alone"), (22, "same " * 30), (23, "x " * 12 + "y")]
    docs = []
    for k in range(80):
        parts = [prose_of(500 + k, rng.randrange(12), 40)]
        for _ in range(rng.randrange(3)):
            words = items[rng.randrange(len(items))][1].split()
            cut = rng.randrange(len(words))
            parts.append(" ".join(rng.choice((words[cut:] + words[:cut], words[: cut + 1], [w.upper() + "!" for w in words]))))
        docs.append((k, "  ".join(parts)))
    want = leaks_by_hand(docs, items)
    found = {(r.doc_id, r.item_id): (r.n_tiles, r.n_covered, r.n_item_words) for r in c.leaks(documents(docs), spark.createDataFrame([(*i, "") for i in items], SCHEMA)).collect()}
    assert found == want and len(want) > 60


def test_repetitive_texts_take_linear_time():
    import time

    began = time.perf_counter()
    one = c.values_of("same " * 100)
    assert c.covered(one, c.values_of("same " * 100_000)) == (1, 100)
    assert time.perf_counter() - began < 3
    pair = c.values_of("a b " * 50)
    assert c.covered(pair, c.values_of("b a " * 50_000)) == (1, 100)
    assert time.perf_counter() - began < 6


def test_odd_rows(spark, documents, prose_of):
    item = prose_of(8, 30, 50_000)
    items = spark.createDataFrame([(1, item, ""), (None, item, ""), (2, None, ""), (3, "", ""), (4, "...", "")], SCHEMA)
    docs = documents([(5, "x " + item), (5, "x " + item), (None, item), (6, None), (7, "..."), (8, prose_of(9, 300_000, 10**7) + " " + item)])
    rows = sorted(((r.doc_id, r.item_id) for r in c.leaks(docs, items).collect()), key=str)
    assert rows == sorted([(d, i) for d in (5, 5, None, 8) for i in (1, None)], key=str)
    assert sorted(r.doc_id for r in c.clean(docs, items).collect()) == [6, 7]


@pytest.fixture(scope="module")
def tables(spark, documents, prose_of):
    items = [(k, prose_of(1000 + k, 20 + 9 * k, 50_000)) for k in range(6)] + [(7, "too short here"), (8, None), (9, prose_of(1001, 29, 50_000))]
    whole = items[1][1].split()
    half = len(items[5][1].split()) // 2
    reordered = " ".join(whole[15:] + whole[:15])
    shouted = "; ".join(w.upper() for w in whole)
    spread = " ".join(" ".join(items[5][1].split()[k : k + 6]) + f" filler{k} more{k}" for k in range(0, 60, 6))
    texts = [
        prose_of(1, 200, 50_000),
        prose_of(2, 50, 50_000) + " " + items[3][1] + " " + prose_of(3, 50, 50_000),
        reordered,
        shouted,
        spread,
        " ".join(items[5][1].split()[: half - 2]) + " " + prose_of(4, 40, 50_000),
        " ".join(items[5][1].split()[: half + 2]),
        None,
        "",
        prose_of(5, 30_000, 50_000) + " " + items[2][1],
        "too short here",
        " ".join(random.Random(1).sample(whole, len(whole))),
    ]
    return documents(texts, extra=True), spark.createDataFrame([(*i, "clash") for i in items], SCHEMA)


#: Items 1 and 9 have the same text.
WANT = {(1, 3), (2, 1), (2, 9), (3, 1), (3, 9), (4, 5), (6, 5), (9, 2), (10, 7)}


def test_leaks(tables):
    docs, items = tables
    found = {(r.doc_id, r.item_id): r for r in c.leaks(docs, items).collect()}
    assert set(found) == WANT
    assert found[1, 3].coverage == 1.0 and found[2, 1].n_tiles == 2 and found[2, 1].coverage == 1.0


def test_other_paths_give_the_same(tables, monkeypatch):
    """By shuffle instead of broadcast, and with a filter that lets everything through."""
    docs, items = tables
    monkeypatch.setattr(c, "ITEM_BYTES", 0)
    monkeypatch.setattr(c, "attached", lambda rows, more, on, how="inner": rows.join(more, on, how))
    monkeypatch.setattr(c, "FILTER_BITS", 64)
    assert {(r.doc_id, r.item_id) for r in c.leaks(docs, items).collect()} == WANT
    assert {r.doc_id for r in c.clean(docs, items).collect()} == set(range(12)) - {d for d, _ in WANT}


def test_clean(tables):
    docs, items = tables
    kept = c.clean(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 5, 7, 8, 11}
    assert c.clean(docs, items.limit(0)).count() == 12 and c.leaks(docs.limit(0), items).count() == 0
    assert c.leaks(docs.union(docs), items).count() == 2 * len(WANT)
