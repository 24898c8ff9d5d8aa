"""Language profiles and lemmas by endings, against versions in plain Python."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from lexforge.operators.languages import grams, learn_profiles, profiled, told_languages
from lexforge.operators.lemmas import completed, guess_lemmas, learn_endings
from lexforge.plans.analyzers import PlainAnalyzer
from lexforge.plans.tokenize import analyze_chunks

TEXTS = [("la", "arma virumque cano Troiae qui primus ab oris"), ("la", "gallia est omnis divisa in partes tres"), ("en", "the quick brown fox jumps over the lazy dog"), ("en", "it was the best of times it was the worst of times"), (None, "nobody knows"), ("la", None), ("en", "xy"), ("grc", "μῆνιν ἄειδε θεὰ Πηληϊάδεω Ἀχιλῆος")]


def test_grams(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["ABcd", "ab", "", None, "éüß"])], "k int, t string")
    assert [r["g"] for r in df.select("k", grams(F.col("t")).alias("g")).orderBy("k").collect()] == [["abc", "bcd"], [], [], [], ["éüß"]]
    long = spark.range(1).select(grams(F.repeat(F.lit("abcdefghij"), 1000)).alias("g")).head()["g"]
    assert len(long) == 3000


def test_profiles_equal_brute_force_and_plug_in(spark):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    found = learn_profiles(df, most=40)
    n = {lang: Counter(t.lower()[k : k + 3] for x, t in TEXTS if x == lang and t for k in range(len(t) - 2)) for lang in ("la", "en", "grc")}
    size = {lang: sum(c.values()) + len(c) for lang, c in n.items()}
    weight = lambda c, s: round(1000 * math.log((c + 1) / s))
    want = {(lang, None): weight(0, max(size.values())) for lang in n}
    want |= {(lang, g): weight(c, size[lang]) for lang in n for g, c in sorted(n[lang].items(), key=lambda x: (-x[1], x[0]))[:40]}
    assert {(r["lang"], r["gram"]): r["weight"] for r in found.collect()} == want
    asked = spark.createDataFrame([(1, "est in partes"), (2, "the times of the fox"), (3, "ἄειδε"), (4, ""), (5, None), (6, "qqqqq")], "id int, text string")
    told = {r["id"]: (r["lang"], r["score"]) for r in told_languages(asked, found, "id").collect()}
    make = profiled(found, lambda: PlainAnalyzer("zz"))
    texts = {r["id"]: r["text"] or "" for r in asked.collect()}
    assert {k: told.get(k, ("",))[0] for k in texts} == dict(zip(texts, make().language(list(texts.values())), strict=True))
    assert [told[k][0] for k in (1, 2, 3)] == ["la", "en", "grc"] and 4 not in told and 5 not in told
    chunks = asked.select(F.lit("v").alias("version_path"), F.col("id").cast("string").alias("chunk_name"), F.lit("s").alias("sha"), F.lit("u").alias("urn"), F.col("text").alias("primary_text"))
    assert {r["chunk_name"]: r["lang"] for r in analyze_chunks(chunks, make).collect() if r["chunk_name"] in "123"} == {"1": "la", "2": "en", "3": "grc"}
    assert told_languages(asked, found.limit(0), "id").isEmpty() and learn_profiles(df.limit(0)).isEmpty()


LEMMAS = [("amavit", "amo"), ("portavit", "porto"), ("cantavit", "canto"), ("vocavit", "voco"), ("rosam", "rosa"), ("terram", "terra"), ("silvam", "silva"), ("vidit", "video"), ("abavit", "x"), ("", "y"), ("solo", "")]


def endings(pairs):
    votes = Counter()
    for text, lemma in set(pairs):
        if text and lemma:
            same = next((k for k, (a, b) in enumerate(zip(text, lemma, strict=False)) if a != b), min(len(text), len(lemma)))
            votes.update((text[-k:], len(text) - same, lemma[same:]) for k in range(1, min(5, len(text)) + 1))
    out = {}
    for ending in {e for e, _, _ in votes}:
        n, cut, put = max((n, -cut, put) for (e, cut, put), n in votes.items() if e == ending)
        if -cut <= len(ending) and n >= 3 and 2 * n > sum(m for (e, _, _), m in votes.items() if e == ending):
            out[ending] = (-cut, put, n)
    return out


def test_endings_equal_brute_force(spark):
    known = spark.createDataFrame([(t, "la", x, None, None) for t, x in LEMMAS] + [("amavit", "la", "amo", None, None)], "text string, lang string, lemma string, upos string, feats string")
    rules = learn_endings(known)
    want = endings(LEMMAS)
    assert {r["ending"]: (r["cut"], r["put"], r["support"]) for r in rules.collect()} == want and "avit" in want and "am" in want
    words = spark.createDataFrame([(t, lang) for t in ("laudavit", "puellam", "vit", "et", "am", "") for lang in ("la", "fr")] * 2, "text string, lang string")
    got = {(r["text"], r["lang"]): r["lemma"] for r in guess_lemmas(words, rules).collect()}
    told = {}
    for t in ("laudavit", "puellam", "vit", "et", "am"):
        k = next((k for k in range(min(5, len(t)), 0, -1) if t[-k:] in want), 0)
        if k and t[: len(t) - want[t[-k:]][0]] + want[t[-k:]][1]:
            told[t, "la"] = t[: len(t) - want[t[-k:]][0]] + want[t[-k:]][1]
    assert got == told and got["laudavit", "la"] == "laudo" and got["puellam", "la"] == "puella"
    whole = {(r["text"], r["lang"]): r["lemma"] for r in completed(known.filter("text <> 'solo' and text <> ''"), words).collect()}
    assert whole["vidit", "la"] == "video" and whole["laudavit", "la"] == "laudo" and ("et", "la") not in whole


def test_an_index_guesses_lemmas_that_the_dictionary_lacks(spark):
    from lexforge.operators.index import build_index
    from lexforge.plans.tokenize import tokenize_native

    none = [F.lit(None).cast("string").alias(c) for c in ("meta_base_urn", "title", "author", "source_repo")]
    rows = spark.createDataFrame([("amavit rosam laudavit", "urn:cts:a:b.c:1")], "primary_text string, urn string").select("*", F.lit(0).alias("root"), F.lit("a/b/c").alias("version_path"), F.struct(F.lit(1).alias("k")).alias("citation_key"), F.lit("la").alias("lang"), *none)
    sidecars = tokenize_native(rows, [c for c in rows.columns if c not in ("urn", "primary_text")])
    known = spark.createDataFrame([(t, "la", x, None, None) for t, x in LEMMAS if t and x], "text string, lang string, lemma string, upos string, feats string")
    lemmas = lambda guess: {r["lemma"] for r in build_index(sidecars, ("la",), lemma_map=known, guess=guess)["lemmas"].collect()}
    assert lemmas(False) == {"amo", "rosa"} and lemmas(True) == {"amo", "rosa", "laudo"}
