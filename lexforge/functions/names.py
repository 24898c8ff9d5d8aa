"""URNs, paths and names, and keys that order them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.schema import SIDECAR_SCHEMA, SIDECAR_SUFFIX

#: Which backend a language uses.
SPACY_MODELS = {"la": "la_core_web_lg", "grc": "grc_dep_web_lg"}
STANZA_LANGS = ("ar", "de", "en", "es", "fa", "fr", "he", "it", "pt")


def urn_base(urn: Column) -> Column:
    """What stands before the last colon; empty without one."""
    return F.when(F.instr(urn, ":") > 0, F.call_function("substring_index", urn, F.lit(":"), F.size(F.split(urn, ":", -1)) - 1)).otherwise(F.when(urn.isNotNull(), F.lit("")))


def urn_ref(urn: Column) -> Column:
    """What stands after the last colon."""
    return F.substring_index(urn, ":", -1)


def urn_is_valid(urn: Column) -> Column:
    """A CTS work: the prefix and three colons at least."""
    return F.coalesce(F.startswith(urn, F.lit("urn:cts:")) & (F.length(urn) - F.length(F.replace(urn, F.lit(":"), F.lit(""))) >= 3), F.lit(False))


def work_path(urn: Column) -> Column:
    """namespace/textgroup/work/version; missing parts are empty components that paths leave out."""
    parts = F.split(urn, ":", 4)
    work = F.split(F.coalesce(F.get(parts, F.lit(3)), F.lit("")), r"\.", -1)
    at = lambda k: F.coalesce(F.get(work, F.lit(k)), F.lit(""))
    return F.array_join(F.filter(F.array(F.coalesce(F.get(parts, F.lit(2)), F.lit("")), at(0), at(1), at(2)), lambda x: x != ""), "/")


def sidecar_name(chunk_name: Column) -> Column:
    """The last suffix gives way to the sidecar's; a leading dot starts a name, not a suffix."""
    return F.concat(F.regexp_replace(chunk_name, r"(?<=[^/])\.[^./]*$", ""), F.lit(SIDECAR_SUFFIX))


def occurrence(identifier: Column) -> Column:
    """The number in brackets at the end of an identifier, 1 without any."""
    digits = F.regexp_extract(identifier, r"\[([0-9]+)\]$", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), F.lit(1))


def hit_urn(base: Column, ref: Column, form: Column, occ: Column) -> Column:
    return F.concat(base, F.lit(":"), ref, F.lit("@"), form, F.lit("["), occ.cast("string"), F.lit("]"))


def natural_key(name: Column) -> Column:
    """Orders refs by their dotted parts: numbers before words, by value; fewer parts first."""
    number = lambda p: p.rlike("^[0-9]+$")
    none = F.lit(0).cast("decimal(38,0)")
    part = lambda p: F.struct(F.when(number(p), 0).otherwise(1).alias("kind"), F.when(number(p), p.cast("decimal(38,0)")).otherwise(none).alias("n"), F.when(number(p), "").otherwise(p).alias("s"))
    return F.transform(F.split(name, r"\.", -1), part)


def path_key(path: Column) -> Column:
    """Orders paths component by component."""
    return F.split(path, "/", -1)


def language_sample(text: Column, limit: int = 3000) -> Column:
    """A text of up to ``limit`` characters whole, else slices from its start, middle and end."""
    width = limit // 3
    middle = F.floor((F.length(text) - width) / 2).cast("int") + 1
    slices = F.concat_ws(" ", F.substring(text, 1, width), F.substring(text, middle, F.lit(width)), F.substring(text, F.length(text) - width + 1, F.lit(width)))
    return F.when(F.length(text) <= limit, text).otherwise(slices)


def pipeline_version(lang: Column, versions: dict[str, str], analyze: tuple = ("la", "grc")) -> Column:
    """What made a sidecar: schema, library, model and mode; it changes when a chunk must be made again."""
    out = F.when(F.coalesce(lang, F.lit("")) == "", F.lit(f"{SIDECAR_SCHEMA}:empty"))
    for code, model in SPACY_MODELS.items():
        mode = "analyze" if code in analyze else "tokenize"
        out = out.when(lang == code, F.lit(f"{SIDECAR_SCHEMA}:spacy-{versions.get('spacy', '')}:{model}-{versions.get(model, '')}:{mode}"))
    return out.otherwise(F.lit(f"{SIDECAR_SCHEMA}:stanza-{versions.get('stanza', '')}:tokenize"))
