"""Main-text extraction: flat text blocks, shallow features of a block and its neighbours, a decision tree.

A page is cut into flat text blocks at block-level tags. Each block gets its word count and link density, those
of the block before and after it, and the regions it lies in (navigation, form, advert and so on). A CART tree
trained on a small labelled table of blocks decides which blocks are main text. The table is a few dozen pages laid
out by hand, a block a word count, a count of linked words and a label, so neighbours are a page's own. One pass over
the pages, no shuffle; a task holds one Arrow batch.

Defined cases: null or empty html gives an empty text; unclosed, truncated or mismatched markup is read as far
as it goes, a self-closed element has no content; a very long page is read whole, in time linear in its length;
a page without <article> falls back on <main> or what is named like it, then on density alone; repeated rows
give repeated rows; other columns of the input are not carried.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm.common import map_batches

#: Comments; elements whose content is no markup; tags with their attributes (quotes count after `=` only); declarations.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:script|style|title|textarea|iframe)/>"
    r"|<(script|style|title|textarea|iframe)(?=[\s/>])((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:(?<=[\"'\s]/)>|>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
#: Attributes that end in a value without quotes, to which a last slash belongs.
UNQUOTED = re.compile(r"=\s*[^\s\"'][^\s]*\Z")
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|aria-label|style)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)

# Element names of HTML and the words by which pages name their regions.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"button", "label", "option"}
#: Elements that an unclosed <p> or <li> outside isn't closed through.
BARRIERS = frozenset("ul ol div article section td table body blockquote nav main noscript template svg math object select canvas audio video".split())
NAV, HEADER, FOOTER, ASIDE, FORM, HINT, ARTICLE, MAIN, HIDDEN, LINK, HEADING, WEAK, SKIP = (1 << k for k in range(13))
TAGS = {"nav": NAV, "menu": NAV, "header": HEADER, "footer": FOOTER, "aside": ASIDE, "dialog": ASIDE, "form": FORM, "fieldset": FORM, "button": FORM, "label": FORM, "article": ARTICLE, "main": MAIN, "a": LINK, "head": HIDDEN, **{f"h{k}": HEADING for k in range(1, 7)}}
TAGS |= dict.fromkeys("noscript template svg math object select canvas audio video".split(), SKIP)
#: Elements whose own names say nothing sure of them: content often has such names.
PLAIN = frozenset("article main h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption table td th tr a b i em strong small code q cite mark u s sub sup time abbr body html".split())
HINTS = (
    (NAV, "nav navbar navigation navigations menu menus breadcrumb breadcrumbs pagination pager toc skip"),
    (HEADER, "header"),
    (FOOTER, "footer colophon copyright contentinfo legal imprint"),
    (ASIDE, "aside side sidebar sidebars sidenav sidemenu rail widget widgets complementary related recommended teaser teasers trending popular"),
    (FORM, "form forms search searchbox login signin signup newsletter subscribe subscription"),
    (HINT, "ad ads adv advert adverts advertisement advertisements adsense advertorial sponsor sponsors sponsored promo promos promotion promoted cookie cookies consent gdpr notice notices alert alerts warning disclaimer popup modal overlay comment comments comentarios kommentare commentaires disqus reply replies respond responses discussion share sharing social toolbar tags masthead banner topbar paywall tooltip"),
    (HIDDEN, "hidden visuallyhidden"),
    (MAIN, "article articlebody content maincontent main post entry story"),
)
NAMED = {word: flag for flag, words in HINTS for word in words.split()}
#: Words that a region's name may have beside its telling one.
FRAME = frozenset("area bar block body bottom box btn button buttons center col column container content fixed global group grid holder icon icons inner item items layout left level line link links list lower main mobile module outer page panel post posts primary right row secondary section set site slot space sticky text title top unit upper wrap wrapper zone".split())
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "page_has_article", "in_article", "in_nav", "in_header", "in_footer", "in_aside", "in_form", "in_hint", "hidden", "heading", "in_weak")
MASKS = np.array([NAV, HEADER, FOOTER, ASIDE, FORM, HINT, HIDDEN, HEADING, WEAK])


def named(tag: str, value: str, attribute: str) -> int:
    """What an element's name says: its flags where all its words are telling or mere frame, WEAK where some are."""
    flags = 0
    for slug in re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower().split() if attribute != "aria-label" else [value.lower()]:
        words = [w for w in re.split(r"[^a-z]+", slug) if w]
        telling = [NAMED[w] for w in words if w in NAMED]
        if not telling:
            continue
        sure = all(w in NAMED or w in FRAME for w in words) and tag not in PLAIN and not (tag == "section" and attribute == "id")
        for flag in telling:
            flags |= flag if sure else 0 if flag == MAIN else WEAK
    return flags


@lru_cache(maxsize=20_000)
def region(tag: str, attributes: str) -> int:
    """The regions that an element opens, by its name and by what its attributes call it."""
    flags = TAGS.get(tag, 0)
    if attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            plain = value.strip().lower()
            if name == "hidden" or (name == "aria-hidden" and plain == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", plain)):
                flags |= HIDDEN
            elif name in ("class", "id", "role", "aria-label") and tag not in ("body", "html"):
                flags |= named(tag, value, name)
                if name == "role" and plain in ("main", "article"):
                    flags |= MAIN if plain == "main" else ARTICLE
    return flags


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, region flags) of each non-empty flat block, in page order."""
    found: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, int]] = []
    pieces: list[str] = []
    linked = flags = 0
    opened = -1  # flags where the block's first text stood
    depth: Counter[str] = Counter()  # open elements by name

    def close() -> None:
        nonlocal linked, opened
        if pieces:
            if text := " ".join("".join(pieces).split()):
                found.append((text, text.count(" ") + 1, linked, max(opened, 0)))
            pieces.clear()
        linked, opened = 0, -1

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not flags & SKIP:
            text = html.unescape(page[at : m.start()])
            pieces.append(text)
            if opened < 0 and not text.isspace():
                opened = flags
            if flags & LINK:
                linked += len(text.split())
        at = m.end()
        tag = m[4]
        if tag is None:
            continue
        tag = tag.lower()
        if m[3]:
            if tag in BLOCKS and not flags & SKIP:
                close()
            if depth[tag]:
                while stack:
                    shut = stack.pop()[0]
                    depth[shut] -= 1
                    if shut == tag:
                        break
                hidden, flags = flags & SKIP, stack[-1][1] if stack else 0
                if hidden and tag in BLOCKS and not flags & SKIP:
                    close()
            continue
        if tag in BLOCKS and not flags & SKIP:
            close()
        elif tag == "br":
            pieces.append(" ")
        if tag in VOID or (m[5].endswith("/") and not UNQUOTED.search(m[5])):
            continue
        shuts = "li" if tag == "li" else "p" if tag in CLOSES_P else None
        if shuts and depth[shuts]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == shuts:
                    for name, _ in stack[k:]:
                        depth[name] -= 1
                    del stack[k:]
                    break
                if stack[k][0] in BARRIERS:
                    break
            flags = stack[-1][1] if stack else 0
        own = region(tag, m[5])
        if own & HEADER and flags & (ARTICLE | MAIN):  # an article's own heading is content
            own &= ~HEADER
        flags |= own
        stack.append((tag, flags))
        depth[tag] += 1
    if at < len(page) and not flags & SKIP:
        text = html.unescape(page[at:])
        if opened < 0 and not text.isspace():
            opened = flags
        pieces.append(text)
    close()
    return found


def features(page: list[tuple[str, int, int, int]]) -> np.ndarray:
    """A row of FEATURES for each block of one page."""
    n = len(page)
    words = np.array([b[1] for b in page], dtype=float)
    density = np.minimum(1.0, np.array([b[2] for b in page], dtype=float) / words)
    flags = np.array([b[3] for b in page], dtype=int)
    article = ARTICLE if (flags & ARTICLE).any() else MAIN
    x = np.zeros((n, len(FEATURES)))
    x[:, 0], x[:, 1] = words, density
    x[1:, 2], x[1:, 3], x[:-1, 4], x[:-1, 5] = words[:-1], density[:-1], words[1:], density[1:]
    x[:, 6], x[:, 7] = (flags & article).any(), (flags & article) != 0
    x[:, 8:] = (flags[:, None] & MASKS) != 0
    return x


#: The small labelled table: a page a line, a block `regions words/linked label`. Regions: A in an article, M in
#: <main>, n navigation, h header, f footer, s aside, q form, x notice, advert, comment or share box, v hidden,
#: w a name that may tell of furniture, H heading. Labels: + main text, - furniture.
LABELLED = """
h2/0- n1/1- n1/1- n2/2- n1/1- x9/0- AH8/0+ A3/0+ A41/0+ A5/0+ A63/2+ A1/0+ A30/0+ f12/0-
n1/1- n1/1- n1/1- x7/0- AH5/0+ A12/0+ A80/0+ A120/3+ A44/0+ f9/0-
n2/2- n3/3- x11/0- AH1/0+ A1/0+ f7/0-
n1/1- x4/0- AH3/0+ A2/0+ A1/0+ A1/0+ A2/0+ f3/0-
n4/4- AH9/9+ A55/0+ A71/4+ A6/0+ AH4/4- A8/8- A7/7- A9/9- A6/6- f20/3-
n1/1- n1/1- AH7/0+ A90/1+ A5/5+ A84/0+ A33/1+ A4/4- A5/5- A3/3- f6/2-
hH2/2- n1/1- n1/1- AH6/0+ A3/0+ A52/0+ A1/1- A1/1- A1/1- A47/0+ A62/0+ A2/0- A6/6- A7/7- A8/8- sH2/0- s6/6- s7/7- f4/0-
AH10/0+ A70/0+ x1/1- x1/1- x1/1- A81/0+ A2/2+ A66/1+ xH1/0- x30/0- x44/1- x3/0- f15/0-
x25/1- n1/1- AH4/0+ A28/0+ A17/0+ A6/0+ A9/0+ A11/0+ A5/0+ q3/0- q1/0- q12/0- f30/0-
x18/2- h6/1- AH12/1+ A8/3+ A64/0+ AH3/0+ A39/0+ AH2/0+ A58/2+ AH3/0- A5/5- A4/4- A6/6- f5/5- f14/0-
n1/1- n1/1- A35/0+ A42/0+ A3/0+ A50/5+ A2/1+ A46/0+ f11/2-
v3/0- v9/0- AH6/0+ Aw45/0+ AwH2/0+ Aw61/1+ Aw38/0+ Aw2/0- Aw1/1- f8/0-
n1/1- AH5/0+ AwH2/0+ Aw70/2+ Aw4/0+ Aw52/0+ A60/0+ Aw3/3- Aw4/4- Aw2/0- f13/1-
5/5- 40/0- 8/0- AH7/0+ A36/0+ A54/0+ A2/0+ 60/1- 12/0- 6/6- H3/0- 25/0- f10/0-
2/0- 1/1- 3/3- A9/0+ A10/0+ A7/1+ A14/0+ H2/0- 35/0- 7/7- 8/8- 1/0-
H6/6- 20/0- AH6/0+ A75/0+ AH3/0+ A1/0+ A4/0+ A2/0+ A88/0+ 3/0- 2/2-
30/0- AH2/0+ A22/0+ w14/0- w40/1- H5/0- 50/0- 9/1- f2/0-
n1/1- n1/1- AH3/0+ A6/1+ A7/1+ A5/1+ A8/2+ A40/0+ A9/4+ A10/4+ A30/0+ A12/12+ A25/0+ f7/7-
AH8/0+ A16/16+ A33/0+ A28/0+ A3/3+ A19/0+ A10/9- A12/12- A14/13- A11/11- A1/1-
n2/2- AH6/0+ A2/2- A1/1- A1/1- A48/0+ A37/0+ A1/0+ A29/0+ A20/0+ A7/6- A6/6- f3/3-
x60/0- AH4/0+ A15/0+ s40/0- s22/3- sH4/0- A18/0+ s3/0- A90/2+ q20/0- q4/0- qH3/0- A21/0+ h3/0- f25/1-
h10/0- h30/0- hH5/0- n6/0- n20/1- nH1/0- A5/0+ A100/0+ A40/0+ v40/0- x3/3- vH2/0- f60/0- fH2/0- f40/2-
AH5/0+ A200/1+ A150/3+ A1/0+ A7/0+ Ax50/0- AxH2/0- Ax90/1- Ax2/2- As45/0- AsH3/0- Aq25/0- AqH2/0- Aq2/0- Af30/1- An6/6- An12/0- Ah8/0- Av20/0-
AH3/0+ A12/0+ As4/4- A45/0+ Ax1/0- A33/0+ An1/1- An1/1- A26/0+ Af4/1- Aq1/0- A3/0+ A8/0+
x5/0- MH6/0+ M45/1+ M3/0+ M52/0+ M4/4- M5/5- M6/6- 8/0- 30/0- f9/1-
n1/1- n1/1- MH4/0+ M1/0+ M20/0+ M70/2+ MH2/0+ M33/0+ 3/0- 12/1- 2/2-
h3/1- MH7/7+ M60/0+ M5/0+ Mx30/0- M44/0+ Ms6/6- M8/1+ M90/0+ 45/0- f12/0-
1/1- 2/2- 1/1- 3/3- H7/0+ 50/1+ 66/0+ 3/0+ 45/2+ 7/0+ 58/0+ 2/2- 4/4- 3/0-
2/2- 1/1- 2/2- 35/0+ 41/0+ 52/3+ 38/0+ 5/5- 6/6- 5/1-
5/0- 1/1- 1/1- 2/2- H5/0+ 28/0+ 61/0+ H3/0+ 72/1+ 14/0+ 6/0+ 40/0+ H2/0- 6/6- 8/8- 5/5- 9/2-
4/4- 3/3- 5/5- H4/0+ 22/1+ 1/0+ 31/0+ 2/0+ 25/0+ 9/9- 12/12- 11/11- 4/0-
H6/0+ 90/0+ 105/2+ H3/0+ 80/0+ 60/5+ 6/3- 2/0- 3/3- 1/1-
3/0- 2/2- 2/2- 3/0- 4/1- H8/0+ 16/0+ 24/2+ 13/0+ 48/0+ 30/30- 5/0- 2/0- 6/6-
x20/0- n1/1- n2/2- H5/0+ 33/0+ x15/0- 47/0+ 26/0+ s30/0- sH2/0- q6/0- f22/0-
h4/0- q2/0- 64/2+ x40/0- 70/0+ 5/0+ 85/1+ xH2/0- x35/0- x28/0- f8/3- f40/0-
w2/0- w1/1- H4/0+ 36/0+ w50/0+ w44/1+ w3/3- 27/0+ w2/0- 1/1- 2/0-
1/0- 2/0- 1/0- 3/0- 2/1- 1/1- 4/0- 3/3- 2/0-
1/1- 1/1- 1/1- 8/8- 10/10- 7/7- 9/9- 12/12- 3/0-
H3/0- 9/9- 8/8- H2/0- 7/7- 10/10- H4/0- 5/5- 6/6- 4/0-
n30/2- n1/0- 18/0+ 55/0+ 21/1+ f50/0- f3/0- 2/0-
1/1- 2/2- 18/0+ 17/0+ 19/0+
1/1- 2/2- 3/3- 16/0+ 20/0+ 14/0+ 15/1+ 18/0+
H3/0+ 18/0+ 21/0+ 1/0+ 24/0+ 2/2- 3/3- 1/1-
2/2- H4/0+ 17/0+ 15/0+ 60/0+ 22/0+
1/1- 1/1- 40/0+ 36/0+ 1/0+ 38/0+ 2/2- 3/3-
v12/0- H9/0+ 100/0+ 4/0+ 120/0+ 8/8- 130/1+ 2/2- 3/3- f1/1-
"""
LETTERS = {"A": ARTICLE, "M": MAIN, "n": NAV, "h": HEADER, "f": FOOTER, "s": ASIDE, "q": FORM, "x": HINT, "v": HIDDEN, "w": WEAK, "H": HEADING}


#: Layouts of each labelled page: as it stands, and with the lengths of its blocks drawn anew around theirs.
LAYOUTS = 40


def labelled_blocks(seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the small labelled table; lengths vary by page so that no cut hangs on one of them."""
    rows, labels, rng = [], [], np.random.default_rng(seed)
    for page in LABELLED.split("\n"):
        found = re.findall(r"([A-Za-z]*)(\d+)/(\d+)([+-])", page)
        for layout in range(LAYOUTS if found else 0):
            blocks_of = []
            for marks, n, linked, _ in found:
                n, linked = int(n), int(linked)
                size = max(1, round(n * float(np.exp(rng.uniform(-0.6, 0.6))))) if layout else n
                if layout % 2 and set(marks) & set("nhfsqxv"):  # named furniture has any length
                    size = round(float(np.exp(rng.uniform(0.0, 5.0))))
                blocks_of.append(("", size, round(size * linked / n), sum(LETTERS[c] for c in marks)))
            rows.append(features(blocks_of))
            labels += [int(sign == "+") for *_, sign in found]
    return np.concatenate(rows), np.array(labels)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 30, least: int = 8) -> tuple:
    """CART by Gini impurity: (feature, cut, tree below or at the cut, tree above), or a leaf's label."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return (int(y.mean() >= 0.5),)
    best = (np.inf, 0, 0.0)
    for k in range(x.shape[1]):
        order = np.argsort(x[:, k], kind="stable")
        v, s = x[order, k], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= least) & (cut <= len(y) - least)]
        if len(cut):
            low, high = s[cut - 1] / cut, (s[-1] - s[cut - 1]) / (len(y) - cut)
            gini = cut * low * (1 - low) + (len(y) - cut) * high * (1 - high)
            at = int(np.argmin(gini))
            if gini[at] < best[0] - 1e-12:
                best = (gini[at], k, (v[cut[at]] + v[cut[at] - 1]) / 2)
    if not np.isfinite(best[0]):
        return (int(y.mean() >= 0.5),)
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def decide(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    out, low = np.empty(len(x), dtype=int), x[:, tree[0]] <= tree[1]
    out[low], out[~low] = decide(tree[2], x[low]), decide(tree[3], x[~low])
    return out


def extract_batch(tree: tuple, pages: list[str | None]) -> list[str]:
    found = [blocks(p) if p else [] for p in pages]
    rows = [features(b) for b in found if b]
    kept = decide(tree, np.concatenate(rows)) if rows else np.empty(0, dtype=int)
    texts, at = [], 0
    for page in found:
        texts.append("\n".join(b[0] for b, keep in zip(page, kept[at : at + len(page)], strict=True) if keep))
        at += len(page)
    return texts


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(key, url, text, n_chars): each page's main text, its blocks joined by newlines."""
    tree = grow(*labelled_blocks())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = extract_batch(tree, batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[key, url, "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return map_batches(pages.select(key, url, markup), work, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint")
