from __future__ import annotations

import pytest

from weftline.llm import html_extract as h

LONG = "A paragraph of the article goes on for a while, with enough words to be told from furniture."


@pytest.fixture(scope="module")
def tree():
    return h.grow(*h.labelled_blocks())


def extract(tree, page):
    return h.extract_batch(tree, [page])[0]


def test_tree_knows_its_table(tree):
    x, y = h.labelled_blocks()
    assert len(x) < 600 * h.LAYOUTS and (h.decide(tree, x) == y).mean() > 0.995


def test_article_without_furniture(tree):
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>x</p>";</script></head><body>
    <header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>gone</p> --><div class="ad">{LONG} Buy now.</div>
    <div id="cookie-notice"><p>{LONG} We use cookies.</p></div><aside class="sidebar"><h3>Related</h3><p>{LONG}</p></aside>
    <article><header><h1>Title &amp;  more</h1></header><p><b>First.<br><p>{LONG} caf&eacute; &#x41;</p><p>Be.</p>
    <form><label>Mail</label><input name=m><button>Send</button><p>{LONG}</p></form><ul class="share"><li>Tweet</li></ul>
    <blockquote>Quoted <i>words</i>here</blockquote><aside><h3>See also</h3></aside><div class="comments"><p>{LONG} I disagree.</p></div></article>
    <footer>&copy; Site. {LONG}</footer></body></html>"""
    assert extract(tree, page).split("\n") == ["Title & more", "First.", f"{LONG} café A", "Be.", "Quoted wordshere"]


def test_pages_without_article(tree):
    page = f'<div class=menu><a href=/>Home</a> <a href=/b>About</a></div><main><h2>Head</h2><p>{LONG}</p></main><p>outside</p>'
    assert extract(tree, page).split("\n") == ["Head", LONG]
    page = f"<ul><li><a href=/>Home</a></li><li><a href=/b>About us</a></li></ul><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>"
    assert extract(tree, page).split("\n") == [LONG] * 3


def test_odd_pages(tree):
    assert extract(tree, None) == extract(tree, "") == extract(tree, "<p>") == extract(tree, "<article><script>x") == ""
    assert extract(tree, f"<article><p>{LONG}</p><p>cut off &am") == f"{LONG}\ncut off &am"
    assert extract(tree, "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    many = "<article>" + "".join(f"<p>{LONG}</p>" for _ in range(5000))
    assert extract(tree, many).count("\n") == 4999


def test_query(spark, documents):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    pages = spark.createDataFrame([(1, "u", "<article><p>é\t\n x</p></article>", "clash", "clash"), (1, "u", None, None, None), (None, None, "<article>y", "", "")], schema)
    rows = sorted(h.main_text(pages).collect(), key=str)
    assert sorted((r.page_id, r.text, r.n_chars) for r in rows if r.page_id) == [(1, "", 0), (1, "é x", 3)]
    assert h.main_text(pages.limit(0)).count() == 0


def test_regions_by_name(tree):
    page = f'<div class="page"><div id="main-content"><h2>Head</h2><p>Be.</p><div class="banner"><p>{LONG}</p></div><p>{LONG}</p></div><div class="side"><p>{LONG}</p></div><section id="responses"><p>{LONG}</p></section></div>'
    assert extract(tree, page).split("\n") == ["Head", "Be.", LONG]
    page = f'<body class="post"><div class="post-header">Top</div><article><div class="article-header"><h1>T</h1></div><p>{LONG}</p><div class="ad-content">{LONG}</div></article></body>'
    assert extract(tree, page).split("\n") == ["T", LONG]


def links(*words):
    return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words)


#: Pages of several kinds and what has to be left of them.
GOLD = [
    (f'<article><p>{LONG}</p><svg width="1"/><p>Second.</p><iframe src="x"/><p>{LONG}</p><canvas/><math/><p>Third.</p></article>', [LONG, "Second.", LONG, "Third."]),
    (f"<article><p title=don't>First</p><p data-x='a>b'>{LONG}</p><p title=it's><a href=/>Here</a> and there</p></article>", ["First", LONG, "Here and there"]),
    (f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><h3>More stories</h3><ul>{links('one more story', 'a second story of the day', 'third one')}</ul></article>", ["Title", LONG, LONG]),
    (f"<article><p>{LONG}</p><div>{links('Tweet', 'Pin', 'Mail')}</div><p>{LONG}</p><ul><li>Milk</li><li>Two eggs</li></ul><p>Mix.</p></article>", [LONG, LONG, "Milk", "Two eggs", "Mix."]),
    (f'<article><p>{LONG}</p><p><a href="/source">The source document</a></p><p>{LONG}</p></article>', [LONG, "The source document", LONG]),
    (f"<article class='post category-legal'><h2 id='related-work'>Related work</h2><section id='discussion'><p>{LONG}</p></section><p>{LONG}</p></article>", ["Related work", LONG, LONG]),
    (f"<ul>{links('Home', 'About us', 'Shop')}</ul><h1>What happened</h1><p>{LONG} {LONG}</p><p>{LONG} {LONG}</p><p>Quite.</p><p>{LONG} {LONG}</p><ul>{links('Imprint', 'Terms of use')}</ul>", ["What happened", f"{LONG} {LONG}", f"{LONG} {LONG}", "Quite.", f"{LONG} {LONG}"]),
    (f"<div>{links('News', 'Sport')}</div><div><p>{LONG} {LONG}</p><p>{LONG} {LONG}</p></div><div><h3>Read on</h3><ul>{links('a', 'b c', 'd e f')}</ul></div>", [f"{LONG} {LONG}"] * 2),
    (f"<article><p>{LONG}<noscript><p>Turn scripts on</p></noscript> goes on</p><video>no player<div>x</div></video><p>End.</p></article><p>{LONG}</p>", [f"{LONG} goes on", "End."]),
    (f"<article><p>Text <svg><title>icon</title><text>label</text></svg> on</p><object><p>lost</article><footer>{LONG}</footer>", ["Text on"]),
    (f"<article><p>{LONG}</p><div class='comments-area'><p>{LONG}</p></div><div class='sidebar-left'><p>{LONG}</p></div><p class=intro>Be.</p></article>", [LONG, "Be."]),
]


@pytest.mark.parametrize(("page", "want"), GOLD)
def test_gold_pages(tree, page, want):
    assert extract(tree, page).split("\n") == want


def test_shallow_features_decide(tree):
    """Random word counts and link densities, own or neighbours', change what is kept of pages with articles too."""
    import numpy as np

    pages = [h.blocks(page) for page, _ in GOLD]
    x = np.concatenate([h.features(b) for b in pages])
    kept, rng = h.decide(tree, x), np.random.default_rng(0)
    inside = (x[:, h.FEATURES.index("in_article")] == 1) & (x[:, 8:16].sum(axis=1) == 0)
    for columns in ((0, 1), (1,), (3, 5), (2, 3, 4, 5)):
        changed = np.zeros(len(x), dtype=bool)
        for _ in range(20):
            other = x.copy()
            for k in columns:
                other[:, k] = rng.uniform(0, 1, len(x)) if k % 2 else rng.integers(1, 90, len(x))
            changed |= h.decide(tree, other) != kept
        assert (changed & inside).sum() >= 3, columns


def test_odd_markup_is_read_in_linear_time(tree):
    import time

    began = time.perf_counter()
    for page in ("<a " * 200_000, "<b>" * 100_000 + "</i>" * 100_000, '<p title="' * 50_000, "<!--" * 200_000, "<script>" * 50_000, "<li>x" * 50_000, "&" * 500_000):
        extract(tree, page)
    assert time.perf_counter() - began < 30
