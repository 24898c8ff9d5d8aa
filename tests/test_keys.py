from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from lexforge.functions.keys import APOSTROPHES, fold_text, is_apostrophe, is_punctuation, with_keys

ALPHA = "α"
# rule by rule, made from their parts: text, language, match key, loose key
GRAVE = [(f"τ{v}̀ν", "grc", f"τ{v}́ν", f"τ{v}ν") for v in "αεηιουω"]
TILDE = [(f"θ{v}̃μα", "grc", f"θ{v}͂μα", f"θ{v}μα") for v in "αηιυω"]
SIGMA = [(f"{v}ς", "grc", f"{v}σ", f"{v}σ") for v in ("νομο", "ΝΟΜΟ")]
ELIDED = [(f"ἀλλ{a}", "grc", "ἀλλ'", "αλλ'") for a in APOSTROPHES]
LATIN = [(w, lang, k, k) for lang in ("la", "lat") for w, k in (("Vulpes", "uulpes"), ("IAM", "iam"), ("jam", "iam"), ("mēnsās", "mensas"), ("ö", "o"))]
OTHER = [("Vulpes", "grc", "vulpes", "vulpes"), ("Größe", "de", "größe", "große"), ("", "en", "", ""), ("naïve", "fr", "naïve", "naive"), ("Jo-Jo 12", "en", "jo-jo 12", "jo-jo 12"), ("O’Neil", "en", "o'neil", "o'neil")]
CASES = [(t, lang, k.lower().replace("ς", "σ"), lo.lower()) for t, lang, k, lo in GRAVE + TILDE + SIGMA + ELIDED + LATIN + OTHER]


@pytest.mark.parametrize("form", ["NFC", "NFD"])
def test_rules_of_both_keys(spark, form):
    norm = lambda f, t: unicodedata.normalize(f, t)
    rows = [(norm(form, t), lang, norm("NFC", k), norm("NFC", lo)) for t, lang, k, lo in CASES]
    got = with_keys(spark.createDataFrame(rows, "key_text string, lang string, want string, want_loose string")).collect()
    assert [(r["key"], r["loose"]) for r in got] == [(r["want"], r["want_loose"]) for r in got]
    assert all((fold_text(t, lang), fold_text(t, lang, loose=True)) == (k, lo) for t, lang, k, lo in rows)


def test_native_and_twin_agree_on_latin_and_greek(spark):
    letters = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x400), *range(0x1F00, 0x2000)] if unicodedata.category(chr(c)) != "Cn"]
    rows = [(f"{a}{c}{b}", lang) for c in letters for a, b in ((ALPHA, "β"), ("J", "v")) for lang in ("grc", "la", "fr")]
    for r in with_keys(spark.createDataFrame(rows, "key_text string, lang string")).collect():
        assert (r["key"], r["loose"]) == (fold_text(r["key_text"], r["lang"]), fold_text(r["key_text"], r["lang"], True)), r


def test_predicates(spark):
    rows = [("’", True), ("ʼ᾽", True), ("", False), ("'a", False), (None, False)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", is_apostrophe(F.col("t"))).collect())
    rows = [(",", True), ("«»", True), ("ʼ", False), ("", False), ("a,", False), (None, False), ("+", True)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", is_punctuation(F.col("t"))).collect())


def test_a_letter_apostrophe_is_a_word_and_marks_elision(spark):
    from lexforge.operators.tokens import key_text, with_urn

    df = spark.createDataFrame([("τ", False, "ʼ"), ("ʼ", True, "x")], "text string, whitespace boolean, next_text string").withColumn("identifier", F.lit("i")).withColumn("chunk_urn", F.lit("u"))
    got = with_urn(df).select("urn", key_text().alias("k")).collect()
    assert [r["k"] for r in got] == ["τ'", "ʼ"] and all(r["urn"] for r in got)
