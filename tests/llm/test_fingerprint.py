from __future__ import annotations

import hashlib
import re
import unicodedata

from weftline.llm import fingerprint as f


def form(text: str) -> str:
    once = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return re.sub(r"\s+", " ", once).strip()


TEXTS = ["Hello  World", "hello world", "ＨＥＬＬＯ\tworld ", None, "", "Straße é", "STRASSE é", "abcdefghi", "abcdefXYZ", "x" * 100_000, "a", "aa", "ab"]


def check(rows, pairs):
    """Against the definition, rows in descending doc_id; `pairs` have distinct ids."""
    text = {i: t or "" for i, t in pairs}
    ids = sorted(text, reverse=True)
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(pairs)
    for k, i in enumerate(ids):
        r, own, after = found[i], text[i], text[ids[(k + 1) % len(ids)]]
        cut = len(own) // 3
        edited = own[: len(own) - cut] + after[:cut]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.near_edited, r.near_next) == (float(form(own) == form(edited)), float(form(own) == form(after)))
    by_print = {}
    for i, r in found.items():
        by_print.setdefault(r.fingerprint, set()).add(form(text[i]))
    assert all(len(v) == 1 for v in by_print.values()) and len(by_print) == len({form(t) for t in text.values()})


def test_against_definition(documents):
    pairs = [(k * 7 - 20, t) for k, t in enumerate(TEXTS)]
    check(f.compare_edits(documents(pairs, extra=True)).collect(), pairs)


def test_many_buckets(documents, monkeypatch):
    monkeypatch.setattr(f, "ROWS", 2)
    monkeypatch.setattr(f, "SIDE", 4)
    pairs = [(k * k, f"text {k % 5} of some length {k // 3}") for k in range(61)]
    check(f.compare_edits(documents(pairs)).collect(), pairs)


def test_edge_tables(documents):
    assert f.compare_edits(documents([(1, "x")]).limit(0)).count() == 0
    [only] = f.compare_edits(documents([(5, "abcdef")])).collect()
    assert only.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and only.near_next == 1.0
    same = f.compare_edits(documents([(1, "abc"), (1, "abc"), (1, "xyz"), (None, "abc")])).collect()
    assert len(same) == 4 and len({r.fingerprint for r in same}) == 2


def test_collisions_are_told_apart(documents, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(f, "wide_hash", lambda form: F.concat(F.lit("h"), F.length(form).cast("string")))
    rows = f.compare_edits(documents([(1, "abc"), (2, "xyz"), (3, "ABC "), (4, "four")])).collect()
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[3] != prints[2] and len({p[:2] for p in prints.values()}) == 2


def test_bucket_lookup(spark, monkeypatch):
    """Lookups in one round and in several count the bounds at or below a value."""
    monkeypatch.setattr(f, "SIDE", 3)
    for bounds in ([5], [1, 4, 9], list(range(-20, 200, 7)), list(range(0, 3000, 11))):
        rows = spark.range(-30, 3100, 13).select("id", f.bucket_of(f.F.col("id"), bounds).alias("k")).collect()
        assert all(r.k == sum(b <= r.id for b in bounds) for r in rows)
