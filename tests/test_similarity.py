from __future__ import annotations

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.functions import similarity

WORDS = st.text(alphabet="abcd ", max_size=90)


def subsequence(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def indel(a: str, b: str) -> float:
    return 1.0 if not a + b else 2 * subsequence(a, b) / (len(a) + len(b))


def partial(a: str, b: str) -> float:
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 1.0 if not b else 0.0
    m = len(a)

    def best(x: str, y: str) -> float:
        cuts = {y[i : i + m] for i in range(len(y) - m + 1)} | {y[:i] for i in range(1, m)} | {y[-i:] for i in range(1, m)}
        return max(indel(x, c) for c in cuts)

    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(a, b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), min_size=1, max_size=8))
def test_kernels_against_definitions(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert np.allclose(similarity.ratio(a, b), [indel(*p) for p in pairs])
    short = [(x[:20], y[:25]) for x, y in pairs]
    assert np.allclose(similarity.partial_ratio([p[0] for p in short], [p[1] for p in short]), [partial(*p) for p in short])
    values = [duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", list(p)).fetchone()[0] if any(p) else 1.0 for p in pairs]
    assert np.allclose(similarity.jaro_winkler(a, b), values)


def test_known_values():
    assert similarity.jaro_winkler(["martha", "dixon"], ["marhta", "dicksonx"]) == pytest.approx([0.961111, 0.813333], abs=1e-6)
    assert similarity.ratio(["apex logistics", ""], ["apex logistic", ""]) == pytest.approx([26 / 27, 1.0])


def test_token_sets():
    def ratio(x: str, y: str) -> float:
        a, b = set(x.split()), set(y.split())
        joined = [" ".join(sorted(s)) for s in (a & b, a - b, b - a)]
        return float(similarity.set_ratio(np.array([len(joined[0])]), [joined[1]], [joined[2]], np.array([not a or not b]))[0])

    assert ratio("", "acme") == 0
    assert ratio("acme works", "works acme intl") == 1
    assert ratio("acme tools", "acme works") == pytest.approx(max(indel("acme tools", "acme works"), 2 * 4 / (4 + 10)))
    assert ratio("abc", "xbz") == pytest.approx(indel("abc", "xbz"))
