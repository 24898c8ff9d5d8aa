"""Lemmas of words that a dictionary doesn't have: rules on their last letters, learned from the words that it has.

A rule says what is cut from the end of a word and what is put there.  Every ending of a known word votes for its word's
rule; an ending keeps the rule of most of its words, if these are enough, and a word follows the longest ending that has
one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of the longest ending, and words that an ending's rule needs.
LONGEST, LEAST = 5, 3


def _endings(text: Column, longest: int) -> Column:
    """The last letters of a word, by one to ``longest`` of them."""
    return F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.length(text))), lambda k: F.right(text, k))


def learn_endings(lemma_map: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Rows (lang, ending, cut, put, support) from (text, lang, lemma); each different row counts once.

    A rule must cut no more than its ending, have ``least`` words, and more than all other words of the ending together.
    """
    known = lemma_map.filter("text <> '' and lemma <> ''").select("text", "lang", "lemma").distinct()
    shared = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.length("text"), F.length("lemma")), F.lit(1))), lambda k: F.left("text", k) == F.left("lemma", k)))
    rows = known.withColumn("_same", shared).select("lang", "text", (F.length("text") - F.col("_same")).alias("cut"), F.substr("lemma", F.col("_same") + 1).alias("put"))
    votes = rows.select("lang", F.explode(_endings(F.col("text"), longest)).alias("ending"), "cut", "put").groupBy("lang", "ending", "cut", "put").agg(F.count("*").alias("n"))
    most = votes.groupBy("lang", "ending").agg(F.sum("n").alias("total"), F.max(F.struct("n", (-F.col("cut")).alias("kept"), "put")).alias("best"))
    rules = most.select("lang", "ending", (-F.col("best.kept")).alias("cut"), F.col("best.put").alias("put"), F.col("best.n").alias("support"), "total")
    return rules.filter((F.col("cut") <= F.length("ending")) & (F.col("support") >= least) & (2 * F.col("support") > F.col("total"))).drop("total")


def guess_lemmas(words: DataFrame, rules: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Rows (text, lang, lemma) of the distinct words that some rule holds for, and of which something is left."""
    each = words.select("text", "lang").distinct()
    met = each.select("text", "lang", F.explode(_endings(F.col("text"), longest)).alias("ending")).join(rules, ["lang", "ending"])
    best = met.groupBy("text", "lang").agg(F.max_by(F.struct("cut", "put"), F.length("ending")).alias("rule"))
    lemma = F.concat(F.left("text", F.length("text") - F.col("rule.cut")), F.col("rule.put"))
    return best.select("text", "lang", lemma.alias("lemma")).filter("lemma <> ''")


def completed(lemma_map: DataFrame, words: DataFrame) -> DataFrame:
    """``lemma_map`` (text, lang, lemma, upos, feats) and guesses for the words that it doesn't have."""
    unknown = words.select("text", "lang").distinct().join(lemma_map.select("text", "lang"), ["text", "lang"], "left_anti")
    none = [F.lit(None).cast("string").alias(c) for c in ("upos", "feats")]
    return lemma_map.select("text", "lang", "lemma", "upos", "feats").unionByName(guess_lemmas(unknown, learn_endings(lemma_map)).select("text", "lang", "lemma", *none))
