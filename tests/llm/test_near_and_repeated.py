from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm import jaccard_join as j
from weftline.llm import substring_dedup as d
from weftline.llm.common import components, ranked

SPACE = "[\x20\x09-\x0d]+"


def words_of(text):
    return [w for w in re.split(SPACE, text or "") if w]


def family(seed: int, n_words: int, copies: int, edits: int, prose) -> list[str]:
    """A text and copies of it with a few words changed each."""
    rng = random.Random(seed)
    base = prose(seed, n_words).split()
    out = [" ".join(base)]
    for _ in range(copies):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def corpus(prose_of):
    licence = prose_of(999, 60)
    texts = [prose_of(k, 20 + k % 90) for k in range(120)]
    texts += [prose_of(500 + k, 40 + k) + " " + licence + " " + prose_of(700 + k, 30) for k in range(40)]
    texts += family(1, 300, 30, 2, prose_of) + family(2, 200, 12, 5, prose_of) + family(3, 60, 8, 1, prose_of)
    texts += ["HELLO there  World", "hello There\tworld", "two words", "two words", "one", None, "", " \t ", "É x y z", "é x y z", texts[0], texts[0].upper()]
    random.Random(0).shuffle(texts)
    return texts


def near_by_hand(pairs, n, percent):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for i, t in pairs:
        w = words_of((t or "").translate(low))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 100)])
def test_near_duplicates_against_all_pairs(documents, corpus, n, percent):
    pairs = [(k * 3, t) for k, t in enumerate(corpus)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in j.near_duplicates(documents(pairs, extra=True), n, percent).collect()}
    assert found == near_by_hand(pairs, n, percent)


def test_keep_one(documents, corpus):
    docs = documents(corpus, extra=True)
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for i, (_, c) in near_by_hand(list(enumerate(corpus)), 5, 80).items() if i == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_near_duplicates_of_odd_tables(documents):
    assert j.near_duplicates(documents(["a"]).limit(0)).count() == 0
    rows = j.near_duplicates(documents([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, None), (3, "a b c d"), (None, None)])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id) == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 2, 1)]
    assert len(rows) == 6
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = j.near_duplicates(documents([(1, long), (2, long + " more"), (3, "w1 w2 w3")])).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 1, 3: 3}


def test_filters_never_lose_a_link(monkeypatch, documents, corpus):
    """The sketch, the seeds and the ranges only order and prune: extreme settings give the same result."""
    pairs = list(enumerate(corpus))
    want = near_by_hand(pairs, 3, 90)
    for name, value in (("SEEDS", 1), ("RANGES", 64), ("SPLIT", 2), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(j, name, value)
    monkeypatch.setattr(j, "rarity", lambda sketch: np.random.default_rng(0).integers(0, 9, j.CELLS, dtype=np.uint16))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in j.near_duplicates(documents(pairs)).collect()} == want


@pytest.mark.parametrize("hot", [0, 4])
def test_hot_ngrams_are_joined_back(monkeypatch, documents, corpus, hot):
    """All n-grams by counts, or those of four rows on; the others by the nearest sizes under the n-gram."""
    pairs = list(enumerate(corpus))
    for name, value in (("HOT", hot), ("BROADCAST_ROWS", 10**9)):
        monkeypatch.setattr(j, name, value)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in j.near_duplicates(documents(pairs)).collect()} == near_by_hand(pairs, 3, 90)


def test_partners_by_size(spark):
    rows = [(g, 10 * g + k, size, 0, cool) for cool in (0, 1) for g, sizes in ((1 + 5 * cool, (100, 91, 50)), (2 + 5 * cool, (7,)), (3 + 5 * cool, (100, 80))) for k, size in enumerate(sizes)]
    grams = spark.createDataFrame(rows, "gram bigint, rep bigint, n bigint, at int, cool int")
    kept = {(r.gram, r.n) for r in j.with_partner(grams, len(rows), 90).collect()}
    assert kept == {(1, 100), (1, 91), (1, 50), (3, 100), (3, 80), (6, 100), (6, 91)}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 40)), st.sets(st.integers(0, 40)), st.integers(0, 20))
def test_suffix_filter_bounds_the_difference(x, y, allowed):
    a, b = (np.array(sorted(v), dtype=np.uint64) for v in (x, y))
    found, exact = j.least_difference(a, b, allowed), len(x ^ y)
    assert found <= exact and (found > allowed) <= (exact > allowed)
    assert abs(len(x) - len(y)) <= found and j.least_difference(a, b, 99, 12) == exact


@pytest.mark.parametrize("copies", [1, 40])
def test_extended_copies_are_linked(documents, prose_of, copies):
    """A set that nearly holds another one: the added n-grams push shared ones out of the longer set's prefix."""
    pairs = []
    for k, more in enumerate((6, 8, 10)):
        text = prose_of(60 + k, 97)
        pairs += [(1000 * k + c, text) for c in range(copies)]
        pairs += [(1000 * k + 500, text + " " + prose_of(80 + k, more, 10**6)), (1000 * k + 600, prose_of(90 + k, more, 10**6) + " " + text)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in j.near_duplicates(documents(pairs)).collect()}
    assert found == near_by_hand(pairs, 3, 90) and {c for _, c in found.values()} == {0, 1000, 2000}


def repeated_by_hand(pairs):
    first, words = {}, {}
    for i, t in sorted(pairs, key=lambda p: p[0]):
        w = words[i] = words_of(t)
        for k in range(len(w) - d.WINDOW + 1):
            first.setdefault(tuple(w[k : k + d.WINDOW]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - d.WINDOW + 1):
            if first[tuple(w[k : k + d.WINDOW])] < i:
                gone[k : k + d.WINDOW] = [True] * d.WINDOW
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_repeated_passages_against_all_windows(documents, corpus, prose_of):
    passage = prose_of(321, 75)
    texts = [*corpus, passage, "ä " + passage + " é", prose_of(5, 49), prose_of(5, 49), prose_of(6, 50), prose_of(6, 50), prose_of(7, 51) + " x", "y " + prose_of(7, 51)]
    texts += [passage + " " + passage + " " + prose_of(9, 20), "same " * 130, "same " * 70, "same " * 49]
    pairs = [(k * 2 - 50, t) for k, t in enumerate(texts)]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in d.dedup(documents(pairs, extra=True)).collect()}
    want = repeated_by_hand(pairs)
    assert found == want and sum(v[1] > 0 for v in want.values()) > 60


def test_repeated_passages_by_broadcast_and_small_automata(documents, corpus, monkeypatch):
    for name, value in (("HOT", 2), ("BROADCAST_ROWS", 400), ("AUTOMATON", 3), ("STRETCH", 2), ("SLICE", 20), ("SLICES", 3)):
        monkeypatch.setattr(d, name, value)
    pairs = list(enumerate(corpus))
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in d.dedup(documents(pairs)).collect()} == repeated_by_hand(pairs)


def test_automata_decide(documents, corpus, monkeypatch):
    """With automata that know every other phrase, or none, windows stay: nothing else locates them."""
    docs, by_hand = documents(corpus), repeated_by_hand(list(enumerate(corpus)))
    whole, compiled = d.compiled, {}
    for name, kept in (("all", lambda p: True), ("half", lambda p: len(p) % 2 == 0), ("none", lambda p: False)):
        monkeypatch.setattr(d, "compiled", lambda phrases, kept=kept: whole(["no phrase", *filter(kept, phrases)]))
        compiled[name] = {r.doc_id: r.n_removed for r in d.dedup(docs).collect()}
    assert compiled["all"] == {i: v[1] for i, v in by_hand.items()}
    lost = {name: sum(v < by_hand[i][1] for i, v in found.items()) for name, found in compiled.items()}
    assert 0 < lost["half"] < lost["none"]


def test_long_texts_with_repeated_passages(documents, prose_of):
    """Passages at both ends and across the slices of a text of 200,000 words, once in a smaller doc_id."""
    a, b = prose_of(70, 2200), prose_of(71, 60)
    long = b + " " + prose_of(72, 99_000, 10**6) + " " + a + " " + prose_of(73, 99_000, 10**6) + " " + b
    rows = {r.doc_id: r.n_removed for r in d.dedup(documents([(1, "x " + a + " y"), (2, long), (3, b), (4, "same " * 100_000), (5, "same " * 60)])).collect()}
    assert rows == {1: 0, 2: 2200, 3: 60, 4: 0, 5: 60}


def test_repeated_passages_of_odd_tables(documents, prose_of):
    assert d.dedup(documents(["a"]).limit(0)).count() == 0
    a, b = prose_of(1, 80), prose_of(2, 80)
    rows = d.dedup(documents([(1, a), (1, a), (1, b), (2, "x " + b), (None, a), (None, "z " + b), (3, None)])).collect()
    assert len(rows) == 7
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in rows if r.doc_id) == [(1, 80, 0), (1, 80, 0), (1, 80, 0), (2, 81, 80), (3, 0, 0)]
    assert {r.n_removed for r in rows if r.doc_id is None} == {0}


@pytest.mark.parametrize("both", [False, True])
def test_repeated_rows_that_lose_a_passage(documents, prose_of, both):
    """Of the rows of a doc_id, one distinct text loses a passage, or two do."""
    a, b = prose_of(1, 80), prose_of(2, 80)
    t, u, v = "x " + a + " y", prose_of(3, 90), "z " + b
    short = prose_of(4, 20)
    rows = [(1, a), (1, b), (2, t), (2, t), (3, t), (3, u), (4, t), (4, short), (5, v), (5, v)] + [(5, a + " q")] * both
    found = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in d.dedup(documents(rows)).collect())
    kept = {a: a, b: b, u: u, short: short, v: "z", a + " q": "q"}
    want = []
    for i, text in rows:
        left = ("x y" if i == 2 else "") if text == t else kept[text]
        size = len(text.split())
        want.append((i, size, size - len(left.split()), hashlib.sha256(left.encode()).hexdigest()))
    assert found == sorted(want)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 200)] + [(500, 400), (400, 450), (9, 9), (600, 601), (600, 601)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(1, 201), 0), 500: 400, 450: 400, 601: 600}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_ranks(spark):
    rows = [(k % 3, k) for k in range(1000)] + [(0, 7), (0, 7)]
    ranks = defaultdict(list)
    for r in ranked(spark.createDataFrame(rows, "g int, v bigint"), ["g"], ["v"], "rank", 8).collect():
        ranks[r.g].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values()) and sum(map(len, ranks.values())) == 1002
