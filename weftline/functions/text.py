"""Normalisation of names, addresses and countries as Catalyst expressions.

All functions map a Column to a Column and stay in the JVM. `transliterate` has a full tier, an Arrow UDF, for
scripts other than Latin; the native tier decomposes with the ICU library that Spark ships.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal forms, as alternatives in this order.
LEGAL_SUFFIXES = (
    r"\bpublic\s+limited\s+company\b",
    r"\bprivate\s+limited\b",
    r"\bpvt\s+ltd\b",
    r"\bltd\b",
    r"\bpvt\b",
    r"\binc\b",
    r"\bincorporated\b",
    r"\bcorp\b",
    r"\bcorporation\b",
    r"\bllc\b",
    r"\bllp\b",
    r"\bco\b",
    r"\bcompany\b",
    r"\bsa\b",
    r"\bsarl\b",
    r"\bsas\b",
    r"\beurl\b",
    r"\bgmbh\b",
    r"\benterprises?\b",
    r"\bservices?\b",
    r"\bsolutions?\b",
    r"\btechnologies?\b",
    r"\bconsultants?\b",
    r"\bconsulting\b",
    r"\bcenters?\b",
    r"\bcentres?\b",
    r"\bassociates\b",
    r"\bholdings\b",
    r"\bgroups?\b",
    r"\bpiraivet\s+limitet\b",
    r"\bpraivet\s+limited\b",
    r"\bpraivet\s+limitet\b",
    r"\belelp\b",
    r"\blimitet\b",
    r"\bpiraivet\b",
    r"\bpraivet\b",
)
# Fixed value: web domain endings.
DOMAIN = r"\.(com|net|org|in|co\.in|io|biz|info|edu|gov|us|fr)\b"
# Address abbreviations, in this order.
ADDRESS_WORDS = {
    "rd": "road",
    "st": "street",
    "ave": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "ct": "court",
    "ste": "suite",
    "apt": "apartment",
    "fl": "floor",
    "no": "number",
    "opp": "opposite",
    "bldg": "building",
    "sec": "sector",
    "str": "strasse",
    "av": "avenue",
    "bvd": "boulevard",
}
# Spellings of countries.
COUNTRIES = {
    "us": ("us", "usa", "united states", "united states of america"),
    "india": ("in", "ind", "india", "bharat"),
    "france": ("fr", "fra", "france"),
}
# Latin letters that don't decompose.
LATIN = {"ß": "ss", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe", "ø": "o", "Ø": "o", "đ": "d", "Đ": "d", "ł": "l", "Ł": "l", "þ": "th", "Þ": "th", "ð": "d", "Ð": "d", "ı": "i", "ħ": "h", "Ħ": "h", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"'}
# Consonants, independent vowels and vowel signs at their common offsets in the Indic blocks.
INDIC_FIRST, INDIC_LAST = 0x0900, 0x0D7F
INDIC = dict(
    [
        *zip(range(0x05, 0x15), "a a i i u u r l e e e ai o o o au".split(), strict=True),
        *zip(range(0x15, 0x3A), "k kh g gh n c ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v s s s h".split(), strict=True),
        *zip(range(0x3E, 0x4D), "a i i u u r r e e e ai o o o au".split(), strict=True),
        *zip(range(0x66, 0x70), "0123456789", strict=True),
    ]
)


def blank(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_of(text: str) -> str:
    """Latin letters for a text of any script that the tables know; through anyascii where it is installed."""
    if text.isascii():
        return text.lower()
    try:
        from anyascii import anyascii
    except ImportError:
        out = []
        for c in text:
            code = ord(c)
            out.append(INDIC.get(code & 0x7F, "") if INDIC_FIRST <= code <= INDIC_LAST else LATIN.get(c, c))
        text = "".join(out)
    else:
        text = anyascii(text)
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


@F.pandas_udf(StringType())
def _transliterated(texts: pd.Series) -> pd.Series:
    return texts.fillna("").map(ascii_of)


def transliterate(text: Column, full: bool = False) -> Column:
    """Lower-case text without accents; null becomes empty. `full` also knows Indic scripts, through Arrow."""
    if full:
        return _transliterated(blank(text))
    out = blank(text)
    plain = out.rlike(r"^\p{ASCII}*$")
    other = F.translate(out, "".join(k for k, v in LATIN.items() if len(v) == 1), "".join(v for v in LATIN.values() if len(v) == 1))
    for letter, latin in LATIN.items():
        if len(latin) > 1:
            other = F.replace(other, F.lit(letter), F.lit(latin))
    other = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), other, F.lit(True))
    return F.lower(F.when(plain, out).otherwise(F.regexp_replace(other, r"\p{M}+", "")))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def business_name(name: Column, strip_legal: bool = True, full: bool = False) -> Column:
    """Domain endings, signs, acronyms, legal forms and remaining punctuation are taken out, in this order."""
    text = F.regexp_replace(transliterate(name, full), DOMAIN, " ")
    text = F.regexp_replace(text, "[&+]", " and ")
    text = F.regexp_replace(text, r"[.,\-–—_/\\()\"'’`#@:;!*\[\]{}~?]", " ")
    text = F.regexp_replace(text, r"\b([a-z])\s+([a-z])\s+([a-z])\b", "$1$2$3")
    text = F.regexp_replace(text, r"\b([a-z])\s+([a-z])\b", "$1$2")
    if strip_legal:
        text = F.regexp_replace(text, "|".join(LEGAL_SUFFIXES), " ")
    return squeeze(F.regexp_replace(text, r"[^\p{L}\p{N}\s]", ""))


def address(text: Column, full: bool = False) -> Column:
    """Separators to spaces, abbreviations spelled out, everything but letters and digits to spaces."""
    out = F.regexp_replace(transliterate(text, full), r"[,;:\-./]", " ")
    for short, word in ADDRESS_WORDS.items():
        out = F.regexp_replace(out, rf"\b{short}\b", word)
    return squeeze(F.regexp_replace(out, r"[^a-z0-9\s]", " "))


def numbers(text: Column) -> Column:
    """Digit runs without leading zeros, of at most eight digits, distinct, in order."""
    runs = F.regexp_extract_all(blank(text), F.lit(r"(?U)(\d+)"), F.lit(1))
    bare = F.transform(runs, lambda x: F.ltrim(x, F.lit("0")))
    return F.array_distinct(F.filter(bare, lambda x: F.length(x).between(1, 8)))


def country(text: Column, full: bool = False) -> Column:
    """One spelling for the countries known, any other as it is; `unknown` where there is none."""
    bare = F.trim(transliterate(text, full))
    out = bare
    for name, spellings in COUNTRIES.items():
        out = F.when(bare.isin(*spellings), F.lit(name)).otherwise(out)
    return F.when(blank(text) == "", F.lit("unknown")).otherwise(out)
