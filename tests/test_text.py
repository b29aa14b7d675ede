from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import keys, text


def column(spark, values, build):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in rows.orderBy("k").select(build(F.col("v"))).collect()]


def test_names(spark):
    given = ["Acme Corp Pvt Ltd", "Global Tech Solutions LLC", "Acme Limited", "A B C Co.", "amazonweb.co.in", "Café Müller & Søn GmbH", None, ""]
    assert column(spark, given, text.business_name) == ["acme", "global tech", "acme limited", "abc", "amazonweb", "cafe muller and son", "", ""]
    assert column(spark, ["a b c d e"], lambda c: text.business_name(c, strip_legal=False)) == ["abc de"]


def test_indic_legal_forms(spark):
    assert column(spark, ["अपेक्स प्राइवेट लिमिटेड"], lambda c: text.transliterate(c, full=True))[0].isascii()


def test_addresses_and_numbers(spark):
    assert column(spark, ["123 MG Rd, Opp SBI, 5th Fl", "st_5 st#5", None], text.address) == ["123 mg road opposite sbi 5th floor", "st 5 street 5", ""]
    assert column(spark, ["0124 MG Road, 560038", "00560 plot 0 123456789", None], text.numbers) == [["124", "560038"], ["560"], []]


def test_countries(spark):
    assert column(spark, ["USA", "Bharat", "FRA", "Germany", " ", "", None], text.country) == ["us", "india", "france", "germany", "", "unknown", "unknown"]


def test_keys(spark):
    assert column(spark, ["ltd group", "acme ltd works"], keys.core_name) == ["ltd group", "acme works"]
    assert column(spark, ["", "ab", "abcde", "aa aa"], lambda c: keys.ngrams(c, 4)) == [[], ["ab"], ["abcd", "bcde"], ["aa a", "a aa"]]
    assert column(spark, ["phoneme", "thick", "quee", "aa"], keys.sound) == ["fnm", "0k", "k", "a"]
    assert column(spark, ["schuck", "x"], keys.metaphone) == ["skk", "x"]
    assert column(spark, ["12 main road, oak lane sector7 12 0012", None], keys.address_words) == [["oak"], []]
