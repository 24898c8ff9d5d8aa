"""Languages of texts by profiles: weights of letter trigrams, learned from labelled texts by aggregates.

A profile holds the most frequent trigrams of a language's samples and the logarithm of their smoothed share, as whole
numbers.  A text's score in a language is the sum over its sample's trigrams, and the best language counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.arrays import let
from lexforge.functions.names import language_sample
from lexforge.schema import LANGID_SAMPLE_CHARS

#: Trigrams that are kept of each language; with so many languages at most, a table of profiles is of bounded size.
GRAMS, LANGUAGES = 2000, 1000
SCALE = 1000
#: Texts that Python works on at once.
SLICE = 512


def grams(text: Column) -> Column:
    """Trigrams of the lower-cased sample of a text; none of a null text and of one under three characters."""
    low = F.lower(language_sample(text, LANGID_SAMPLE_CHARS))
    threes = lambda c: F.transform(c, lambda x, k: F.concat(x, F.get(c, k + 1), F.get(c, k + 2)))
    # the sample is made and split once; the last two characters begin no trigram
    return F.coalesce(let(F.split(low, ""), lambda c: F.slice(threes(c), 1, F.greatest(F.size(c) - 2, F.lit(0)))), F.array().cast("array<string>"))


def _sample(text: Column) -> Column:
    return F.lower(language_sample(text, LANGID_SAMPLE_CHARS))


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of texts as numbers, and which text each is of; none of a null text and of one under three characters."""
    whole = [t or "" for t in texts]
    chars = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(whole)), [len(t) for t in whole])
    inside = owner[:-2] == owner[2:]
    return ((chars[:-2] << 42) | (chars[1:-1] << 21) | chars[2:])[inside], owner[:-2][inside]


def _gram(code: int) -> str:
    return chr(code >> 42) + chr(code >> 21 & 0x1FFFFF) + chr(code & 0x1FFFFF)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, gram, n) of the texts of a slice, from (lang, sample)."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            langs, texts = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
            for lang in set(langs):
                found, n = np.unique(_codes([t for t, x in zip(texts, langs, strict=True) if x == lang])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array([_gram(c) for c in found.tolist()], pa.string()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = GRAMS) -> DataFrame:
    """Rows (lang, gram, weight), and one with a null gram for each language, the weight of what its profile doesn't hold.

    Rows without a language are left out.  Equal counts are kept in the order of their trigrams.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), _sample(F.col(text_col)).alias("sample"))
    counts = rows.mapInArrow(_counted, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = counts.withColumn("_rank", first).filter(F.col("_rank") <= most).drop("_rank")
    weight = lambda n, size: F.round(SCALE * F.log((n + 1) / size)).cast("long")
    size = F.col("total") + F.col("kinds")
    held = kept.join(sums, "lang").select("lang", "gram", weight(F.col("n"), size).alias("weight"))
    # unknown trigrams weigh the same in all languages, as in the one with the most text
    most = F.broadcast(sums.agg(F.max(size).alias("most")))  # a single row
    return held.unionByName(sums.select("lang").join(most, F.lit(True)).select("lang", F.lit(None).cast("string").alias("gram"), weight(F.lit(0), F.col("most")).alias("weight")))


def told_languages(texts: DataFrame, profiles: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Rows (id, lang, score) of the texts that have trigrams; of equal scores the first language by name counts.

    What a text gains over the weight of unknown trigrams is added up where the text is read; only sums by language move.
    Rows that share an id are one text.  Profiles are of bounded size, and travel with the function.
    """
    known = profiles.collect()
    floors = {r["lang"]: r["weight"] for r in known if r["gram"] is None}
    langs = sorted(floors, key=str.encode)
    place = {x: k for k, x in enumerate(langs)}
    held = sorted((ord(r["gram"][0]) << 42 | ord(r["gram"][1]) << 21 | ord(r["gram"][2]), place[r["lang"]], r["weight"] - floors[r["lang"]]) for r in known if r["gram"] is not None)
    code, lang_of, gain = (np.array([h[k] for h in held], np.int64) for k in range(3))
    base = np.array([floors[x] for x in langs], np.int64)

    @F.arrow_udf("array<bigint>")
    def scores(samples: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(samples), SLICE):
            texts = samples.slice(at, SLICE).to_pylist()
            codes, owner = _codes(texts)
            low = np.searchsorted(code, codes, "left")
            n = np.searchsorted(code, codes, "right") - low  # the languages that hold a trigram stand together
            at_held = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.empty(0, np.int64)
            gains = np.bincount(np.repeat(owner, n) * len(langs) + lang_of[at_held], gain[at_held], len(texts) * len(langs)).astype(np.int64)  # whole numbers under 2^53
            each = np.bincount(owner, minlength=len(texts))
            total = gains.reshape(len(texts), len(langs)) + each[:, None] * base
            out += [row if k else None for row, k in zip(total.tolist(), each.tolist(), strict=True)]
        return pa.array(out, pa.list_(pa.int64()))

    if not langs:
        return texts.select(F.col(id_col).alias("id"), F.lit("").alias("lang"), F.lit(0).cast("long").alias("score")).filter(F.lit(False))
    rows = texts.select(F.col(id_col).alias("id"), scores(_sample(F.col(text_col))).alias("scores")).select("id", F.posexplode("scores").alias("place", "score"))
    summed = rows.groupBy("id", "place").agg(F.sum("score").alias("score"))
    best = summed.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("loss"), "place")).alias("best"))
    return best.select("id", F.get(F.lit(langs), F.col("best.place")).alias("lang"), (-F.col("best.loss")).alias("score"))


class Profiled:
    """An analyzer whose languages come from profiles, and whose tokens come from another."""

    def __init__(self, weights: dict[str, dict[str, int]], floors: dict[str, int], inner: object):
        self.weights, self.floors, self.inner = weights, floors, inner
        self.ids_count_along = getattr(inner, "ids_count_along", True)

    def language(self, texts: list[str]) -> list[str]:
        return [self._language(t.lower()) for t in texts]

    def _language(self, text: str) -> str:
        found = [text[k : k + 3] for k in range(len(text) - 2)]
        scores = {lang: sum(self.weights[lang].get(g, floor) for g in found) for lang, floor in self.floors.items()}
        return min(scores, key=lambda lang: (-scores[lang], lang), default="") if found else ""

    def tokens(self, lang: str, segments: list[str]) -> list[list[dict]]:
        return self.inner.tokens(lang, segments)


def profiled(profiles: DataFrame, inner: Callable[[], object]) -> Callable[[], Profiled]:
    """A maker of analyzers for ``analyze_chunks``; profiles are of bounded size, and travel with the function."""
    weights: dict[str, dict[str, int]] = {}
    floors: dict[str, int] = {}
    for r in profiles.collect():
        if r["gram"] is None:
            floors[r["lang"]] = r["weight"]
        else:
            weights.setdefault(r["lang"], {})[r["gram"]] = r["weight"]
    return lambda: Profiled({lang: weights.get(lang, {}) for lang in floors}, floors, inner())
