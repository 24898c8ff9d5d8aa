"""Match keys: what a searcher types and what a text has, folded to the same string.

``match_key`` keeps accents but not case, grave against acute, final sigma, kinds of apostrophes, or Latin u/v and i/j;
``loose_key`` drops all combining marks too.  The columns run in the JVM; ``fold_text`` is their twin for Python.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Signs that stand for an elision, and marks that are written for each other.
APOSTROPHES = "'’ʼ᾽′΄"
GRAVE, ACUTE, TILDE, PERISPOMENI = "̀", "́", "̃", "͂"
LATIN = ("la", "lat")


def is_apostrophe(text: Column) -> Column:
    """Not empty, and apostrophes only."""
    return F.coalesce(text.rlike(f"^[{APOSTROPHES}]+$"), F.lit(False))


def is_punctuation(text: Column) -> Column:
    """Not empty, and characters of the categories P and S only."""
    return F.coalesce(text.rlike(r"^[\p{P}\p{S}]+$"), F.lit(False))


def _normal(text: Column, form: str) -> Column:
    return F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit(form), text, F.lit(False))


def _folded(text: Column, lang: Column, loose: bool) -> Column:
    latin = F.coalesce(lang.isin(*LATIN), F.lit(False))
    plain = F.translate(_normal(text, "decompose"), APOSTROPHES, "'" * len(APOSTROPHES))
    bare = F.regexp_replace(plain, r"\p{M}", "")
    marked = bare if loose else F.when(latin, bare).otherwise(F.translate(plain, GRAVE + TILDE, ACUTE + PERISPOMENI))
    low = F.translate(F.lower(marked), "ς", "σ")
    full = _normal(F.when(latin, F.translate(low, "jv", "iu")).otherwise(low), "compose")
    # plain letters need no normaliser, which is called by reflection
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), F.when(latin, F.translate(F.lower(text), "jv", "iu")).otherwise(F.lower(text))).otherwise(full)


def match_key(text: Column, lang: Column) -> Column:
    """Folds all but accents (for Latin, accents too)."""
    return _folded(text, lang, loose=False)


def loose_key(text: Column, lang: Column) -> Column:
    """Folds accents as well."""
    return _folded(text, lang, loose=True)


def with_keys(vocabulary: DataFrame, text: str = "key_text", lang: str = "lang") -> DataFrame:
    """``vocabulary`` with ``key`` and ``loose``.  The normaliser is not foldable for Spark, so it is for distinct words."""
    return vocabulary.withColumn("key", match_key(F.col(text), F.col(lang))).withColumn("loose", loose_key(F.col(text), F.col(lang)))


_SAME_APOSTROPHE = dict.fromkeys(map(ord, APOSTROPHES), "'")
_SAME_MARK = {ord(GRAVE): ACUTE, ord(TILDE): PERISPOMENI}
_SAME_LETTER = str.maketrans("jv", "iu")


def fold_text(text: str, lang: str, loose: bool = False) -> str:
    """The twin of ``match_key`` and ``loose_key`` for one string."""
    low = unicodedata.normalize("NFD", text).translate(_SAME_APOSTROPHE)
    if loose or lang in LATIN:
        low = "".join(c for c in low if unicodedata.category(c)[0] != "M")
    else:
        low = low.translate(_SAME_MARK)
    low = low.lower().replace("ς", "σ")
    return unicodedata.normalize("NFC", low.translate(_SAME_LETTER) if lang in LATIN else low)
