"""Tokens and keys of normalised names and addresses, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import numbers

# Words of legal forms.
LEGAL_TOKENS = tuple("ltd limited pvt private inc incorporated corp corporation llc llp co company services service solutions solution holdings group enterprises center centre associates consultants consultant consulting international intl gmbh sarl sas sa".split())
# Words that say little in an address.
ADDRESS_STOPWORDS = tuple(
    "road street avenue lane drive nagar near opposite behind floor shop plot cross main north south east west blvd court circle highway parkway suite block sector village fl st rd ave dr ln colony city state bazaar marg bhavan complex towers tower building bldg plaza enclave layout dist district post po pin zip india usa".split()
)
# Words that say little in a name.
STOPWORDS = (*LEGAL_TOKENS, *"the and for with all india state department".split())


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def legal_free(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(*LEGAL_TOKENS))


def core_name(name: Column) -> Column:
    """The name without words of legal forms; the whole name if nothing else is in it."""
    words = F.array_join(legal_free(tokens(name)), " ")
    return F.when(words == "", name).otherwise(words)


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(tokens(text)), " ")


def unspaced(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def telling(words: Column) -> Column:
    """Words of three letters or more that aren't stopwords."""
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*STOPWORDS))


def ngrams(text: Column, n: int) -> Column:
    """Character n-grams in order, repeats and spaces included; a shorter text is its own only one."""
    size = F.length(text)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(size == 0, F.array().cast("array<string>")).otherwise(cut)


def without_vowels(word: Column) -> Column:
    return F.concat(F.substring(word, 1, 1), F.regexp_replace(F.substring(word, F.lit(2), F.length(word)), "[aeiou]", ""))


def collapsed(word: Column) -> Column:
    out = F.regexp_replace(F.lower(word), r"(.)\1+", "$1")
    return F.when(F.endswith(out, F.lit("e")) & (F.length(out) > 2), F.substring(out, F.lit(1), F.length(out) - 1)).otherwise(out)


def sound(word: Column) -> Column:
    """The blocking channels' phonetic key of a word."""
    out = F.regexp_replace(collapsed(word), "ck|qu", "k")
    return without_vowels(F.replace(F.replace(out, F.lit("ph"), F.lit("f")), F.lit("th"), F.lit("0")))


def metaphone(word: Column) -> Column:
    """The features' phonetic key of a word, which differs from `sound` in its rules and their order."""
    out = collapsed(word)
    for old, new in (("ck", "k"), ("ph", "f"), ("sch", "sk"), ("th", "0"), ("qu", "k")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.when(F.length(word) < 2, word).otherwise(without_vowels(out))


def first_sounds(name: Column, key=sound, separator: str = "_", n: int = 3) -> Column:
    """Keys of the first n words that aren't legal forms and have two letters or more; empty if there are none."""
    words = F.filter(tokens(name), lambda w: ~w.isin(*LEGAL_TOKENS) & (F.length(w) >= 2))
    return F.array_join(F.transform(F.slice(words, 1, n), key), separator)


def address_numbers(address: Column) -> Column:
    return numbers(F.lower(address))


def address_words(address: Column) -> Column:
    """Words of three letters or more that are no stopwords, repeats included."""
    text = F.regexp_replace(F.lower(F.coalesce(address, F.lit(""))), r"[.,\-–—_/\\()\"'`#@:;!*\[\]{}~?]", " ")
    words = F.regexp_extract_all(text, F.lit(r"\b([a-z]{3,})\b"), F.lit(1))
    return F.filter(words, lambda w: ~w.isin(*ADDRESS_STOPWORDS))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats: 1 if both are empty, 0 if one is."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1)))
