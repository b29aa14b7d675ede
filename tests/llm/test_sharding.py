from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
import xxhash

from weftline.llm import sharding as s


def check(rows, texts, shards=8):
    """Sizes, checksums and slots; returns each shard's bytes and the shards of each text."""
    assert len(rows) == len(texts)
    slots, load, where = defaultdict(list), dict.fromkeys(range(shards), 0), defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        where[raw].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    return load, where


def test_even_sizes_and_whole_groups(documents):
    rng = random.Random(5)
    texts = ["wörd " * rng.randrange(1, 60) + ("\n" * (k % 4)) + str(k) for k in range(3000)] + ["copy of a text " * 9] * 150 + [None, "", ""]
    load, where = check(s.shard(documents(texts, extra=True)).collect(), texts)
    assert max(load.values()) - min(load.values()) < 0.02 * max(load.values())
    assert all(len(v) == 1 for v in where.values())


def test_a_text_in_a_third_of_the_rows_is_split_evenly(documents):
    texts = [f"text number {k} " + "ab" * (k % 40) for k in range(1200)] + ["hot " * 20] * 800
    load, where = check(s.shard(documents(texts)).collect(), texts)
    assert max(load.values()) - min(load.values()) < 0.02 * max(load.values())
    assert sum(len(v) > 1 for v in where.values()) == 1


def test_edge_tables(documents):
    assert s.shard(documents(["a"]).limit(0)).count() == 0
    for texts in (["a"], ["a", "a", None], ["same"] * 50, ["x" * 100_000, "y", "z"]):
        check(s.shard(documents(texts)).collect(), texts)


def tree_by_hand(texts, shards=8):
    """Shards of distinct texts by a plain k-d tree: sort, add up, cut nearest to the goal, go on in both halves."""
    points = {}
    for t in texts:
        raw = (t or "").encode()
        tie = xxhash.xxh64_intdigest(raw, seed=42) % (1 << s.HASH_BITS)
        width = len(raw) * 1000 // max(1, len(t or ""))
        at = points.setdefault(raw, [(len(raw) + 1, width, raw.count(b"\n")), tie, 0])
        at[2] += len(raw) + 1
    spread = [max(p[0][k] for p in points.values()) - min(p[0][k] for p in points.values()) for k in range(3)]
    leaf = {}

    def cut(own, low, high):
        if high - low == 1 or not own:
            leaf.update(dict.fromkeys(own, low))
            return
        middle = (low + high) // 2
        wide = [(max(points[p][0][k] for p in own) - min(points[p][0][k] for p in own)) / max(1, spread[k]) for k in range(3)]
        k = wide.index(max(wide))
        order = sorted(own, key=lambda p: (points[p][0][k], points[p][1]))
        goal = sum(points[p][2] for p in own) * (middle - low) / (high - low)
        below, n = 0, 0
        while below + points[order[n]][2] < goal:
            below += points[order[n]][2]
            n += 1
        n += below + points[order[n]][2] - goal < goal - below
        cut(order[:n], low, middle)
        cut(order[n:], middle, high)

    cut(list(points), 0, shards)
    return leaf


@pytest.mark.parametrize("shards", [8, 5])
def test_tree_against_one_by_hand(documents, shards):
    rng = random.Random(9)
    texts = ["wörd " * rng.randrange(1, 12) + "\n" * rng.randrange(4) + "x" * rng.randrange(60) + str(rng.randrange(700)) for k in range(1000)] + [None, ""]
    want = tree_by_hand(texts, shards)
    for r in s.shard(documents(texts), shards).collect():
        assert r.shard == want[(texts[r.doc_id] or "").encode()]


def test_the_tree_places_all_but_a_leaf_of_copies(spark, documents, monkeypatch):
    """Without groups heavier than a leaf nothing is dealt but by the tree, whatever the table's size."""
    seen = []
    whole = s.whole_leaves
    monkeypatch.setattr(s, "whole_leaves", lambda *a: seen.append(whole(*a)) or seen[-1])
    texts = ["a long text " * 400, "b long text " * 300, "c" * 4000, *(f"short {k}" for k in range(40)), *["copy"] * 30]
    check(s.shard(documents(texts)).collect(), texts)
    assert seen == [[]]
    s.shard(documents(texts + ["copies of one text"] * 3000)).count()
    assert 5 <= len(seen[1]) <= 7 and len({p[:3] for p in seen[1]}) == 1


def test_mid_sized_groups_stay_whole_and_sizes_near(documents):
    rng = random.Random(4)
    texts = [f"text {k} " + "ab" * rng.randrange(40) for k in range(1500)]
    total = sum(len(t) + 1 for t in texts)
    for k, share in enumerate((0.02, 0.03, 0.05, 0.07, 0.04)):
        copy = f"group {k} of copies " * 3
        texts += [copy] * int(share * total / len(copy))
    load, where = check(s.shard(documents(texts)).collect(), texts)
    assert all(len(v) == 1 for v in where.values())
    assert max(load.values()) < 1.1 * sum(load.values()) / 8 and min(load.values()) > 0.9 * sum(load.values()) / 8


def test_target_bytes_decide_the_number_of_shards(documents):
    texts = [f"text {k} " + "ab" * (k % 30) for k in range(600)]
    load = {}
    for r in s.shard(documents(texts), target_bytes=2000).collect():
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert len(load) == -(-sum(load.values()) // 2000) and max(load.values()) < 2200
