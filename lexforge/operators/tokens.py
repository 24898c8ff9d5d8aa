"""Tokens: the offline tokenizer, finalising model output, identifiers, elision, and segments put back together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.functions.keys import is_apostrophe, is_punctuation
from lexforge.schema import CONTEXT_PART, TOKEN_SEP

#: The offline tokenizer's tokens: runs of letters, marks and digits, or one other sign; with the space after them, if any.
#: A run is never given back, so that the matcher keeps no stack of its letters.
TOKEN = r"(?:[\p{L}\p{M}\p{N}]++|[^\s\p{L}\p{M}\p{N}])\s?"
_SPACES = " \t\n\x0b\f\r"
_BLANK = r"^(?U:\s)+|(?U:\s)+$"
#: The characters that this takes for blanks.
BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Rows of a batch that Python works on at once.
SLICE = 512


def token_list(text: Column) -> Column:
    """array<struct<text, whitespace>> of the offline tokenizer; empty for a null or blank text."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.transform(pieces, lambda p: F.struct(F.rtrim(p, F.lit(_SPACES)).alias("text"), (F.length(F.rtrim(p, F.lit(_SPACES))) < F.length(p)).alias("whitespace")))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _counted(texts: pa.Array) -> pa.Array:
    """The how-manieth of its text each element of a list is.  Sorted by list and text, a place less the place where its run begins is the count."""
    counts = [np.empty(0, np.int32)]
    for k in range(0, len(texts), SLICE):
        rows = texts.slice(k, SLICE)
        codes = rows.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(rows)), rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        key = owner * (codes.max(initial=0) + 1) + codes
        order = np.argsort(key, kind="stable")
        place = np.arange(len(key))
        begins = np.diff(key[order], prepend=-1) != 0
        occ = np.empty(len(key), np.int32)
        occ[order] = place - np.maximum.accumulate(np.where(begins, place, 0)) + 1
        counts.append(occ)
    offsets = np.concatenate([[0], np.cumsum(texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(counts)))


def occurrences(tokens: Column) -> Column:
    """array<int>: the how-manieth of its exact text each token of an array is, from 1.

    ``tokens`` should be a column, since an expression would be made once more for the count.
    """
    return _counted(F.transform(tokens, lambda t: t["text"]))


def named_tokens(tokens: Column, chunk_urn: Column) -> Column:
    """``tokens`` (text, whitespace), a column, of one chunk with occ, identifier and urn, in place: no row leaves its task.

    Words get a URN of chunk and identifier, punctuation and tokens of a chunk without a URN none.
    """

    def named(z: Column) -> Column:
        identifier = F.concat(z["t"]["text"], F.lit("["), z["occ"].cast("string"), F.lit("]"))
        return F.struct(z["t"]["text"].alias("text"), z["t"]["whitespace"].alias("whitespace"), z["occ"].alias("occ"), identifier.alias("identifier"), F.when(~is_punctuation(z["t"]["text"]), F.concat(z["urn"], F.lit("@"), identifier)).alias("urn"))

    # the chunk's URN stands beside every token, so that the lambda refers to nothing outside
    return F.transform(F.arrays_zip(tokens.alias("t"), occurrences(tokens).alias("occ"), F.array_repeat(chunk_urn, F.size(tokens)).alias("urn")), named)


def named_rows(df: DataFrame, tokens: str, chunk_urn: str) -> DataFrame:
    """A row for each token of an array ``tokens`` (text, whitespace, ...), with occ, identifier and urn as ``named_tokens`` has them, and its place ``seq`` unless the token has one."""
    keep = [c for c in df.columns if c not in (tokens, chunk_urn)]
    rows = df.select(*keep, F.col(chunk_urn).alias("_urn"), F.posexplode(F.arrays_zip(F.col(tokens).alias("t"), occurrences(F.col(tokens)).alias("occ"))).alias("_place", "z"))
    place = [] if "seq" in rows.schema["z"].dataType["t"].dataType.names else [F.col("_place").alias("seq")]
    rows = rows.select(*keep, "_urn", *place, "z.t.*", "z.occ", F.concat("z.t.text", F.lit("["), F.col("z.occ").cast("string"), F.lit("]")).alias("identifier"))
    return with_urn(rows, "_urn").drop("_urn")


def explode_tokens(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """A row for each token, with its place ``seq`` among all tokens of its chunk (punctuation too) and ``next_text``."""
    pairs = F.arrays_zip(F.col(tokens).alias("t"), F.slice(F.transform(tokens, lambda t: t["text"]), 2, F.greatest(F.size(tokens), F.lit(1))).alias("n"))
    keep = [c for c in df.columns if c != tokens]
    return df.select(*keep, F.posexplode(pairs).alias("seq", "pair")).select(*keep, "seq", F.col("pair.t").alias("token"), F.col("pair.n").alias("next_text")).select(*keep, "seq", "token.*", "next_text")


def with_urn(tokens: DataFrame, chunk_urn: str = "chunk_urn") -> DataFrame:
    """Rows of tokens with URNs: words get one of chunk and identifier, punctuation has none."""
    return tokens.withColumn("urn", F.when(~is_punctuation(F.col("text")), F.concat(F.col(chunk_urn), F.lit("@"), "identifier")))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _slices(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Slices of texts by characters, without outer blanks; a list's bounds are read in slices of the batch."""
    out = []
    for k in range(0, len(texts), SLICE):
        rows = zip(*(x.slice(k, SLICE).to_pylist() for x in (texts, starts, ends)), strict=True)
        out.append(pa.array([None if a is None else [None if i is None or j is None else text[max(i, 0) : max(i, 0) + max(j - i, 0)].strip(BLANKS) for i, j in zip(a, b, strict=True)] for text, a, b in rows], pa.list_(pa.string())))
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.string()))


def own_texts(text: Column, tokens: Column) -> Column:
    """Model ``tokens`` (start_char, end_char, text, ...), a column, of one text, with the text's own words in place of the model's.

    The slice of the text without outer blanks counts; where it is empty, the model's own text; tokens without either go,
    and the rest keep their order.
    """
    cuts = _slices(F.coalesce(text, F.lit("")), F.transform(tokens, lambda t: t["start_char"]), F.transform(tokens, lambda t: t["end_char"]))
    own = lambda z: z["t"].withField("text", F.coalesce(F.nullif(z["cut"], F.lit("")), F.nullif(F.regexp_replace(z["t"]["text"], _BLANK, ""), F.lit(""))))
    return F.filter(F.transform(F.arrays_zip(tokens.alias("t"), cuts.alias("cut")), own), lambda t: t["text"].isNotNull())


def key_text(text: str = "text", whitespace: str = "whitespace", next_text: str = "next_text") -> Column:
    """An elided word, one that an apostrophe follows without a space, is looked up with it."""
    elided = (~F.coalesce(F.col(whitespace), F.lit(False))) & is_apostrophe(F.col(next_text))
    return F.when(elided, F.concat(F.col(text), F.lit("'"))).otherwise(F.col(text))


def words_only(tokens: DataFrame) -> DataFrame:
    """Tokens with a URN; their ``seq`` still counts the others."""
    return tokens.filter(F.coalesce(F.col("urn"), F.lit("")) != "")


def first_word(tokens: DataFrame) -> DataFrame:
    """lemma, upos and feats of the first of a token's words."""
    word = F.get("words", F.lit(0))
    return tokens.withColumn("lemma", word["lemma"]).withColumn("upos", word["upos"]).withColumn("feats", word["feats"]).drop("words")


def indexed_lemma(lemma: Column) -> Column:
    """Null unless the lemma says something: not empty, and not an apostrophe."""
    return F.when((F.coalesce(lemma, F.lit("")) != "") & ~is_apostrophe(lemma), lemma)


def context_windows(chunks: DataFrame, keep: list[str], tokens: str = "tokens", width: int = CONTEXT_PART) -> DataFrame:
    """Rows (keep, part, tokens): the texts of ``width`` tokens in turn, each with its space, parted by a control sign."""
    texts = F.transform(tokens, lambda t: F.concat(t["text"], F.when(F.coalesce(t["whitespace"], F.lit(False)), " ").otherwise("")))
    rows = chunks.filter(F.size(tokens) > 0).select(*keep, texts.alias("_texts"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("_texts") - 1) / width).cast("int")), lambda p: F.array_join(F.slice("_texts", p * width + 1, F.lit(width)), TOKEN_SEP))
    return rows.select(*keep, F.posexplode(parts).alias("part", "tokens"))


def shift_segments(pieces: DataFrame, chunk: list[str], counted: bool = True) -> DataFrame:
    """``pieces`` (chunk columns, piece, char_offset, tokens) with their tokens in the coordinates of the whole text.

    Characters move on by the piece's offset; ids, which are ``counted`` along the chunk, and the words' ids and heads by
    the tokens of the pieces before.  Pieces stay rows, so that those of one text may be made by many tasks.
    """
    before = F.coalesce(F.sum(F.size("tokens")).over(Window.partitionBy(*chunk).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    has_words = "words" in pieces.schema["tokens"].dataType.elementType.names

    def moved(t: Column) -> Column:
        out = t.withField("start_char", t["start_char"] + F.col("char_offset")).withField("end_char", t["end_char"] + F.col("char_offset"))
        if not counted:
            return out
        out = out.withField("id", F.transform(t["id"], lambda i: i + F.col("_before")))
        return out.withField("words", F.transform(t["words"], lambda w: w.withField("id", w["id"] + F.col("_before")).withField("head", w["head"] + F.col("_before")))) if has_words else out

    return pieces.withColumn("_before", before).withColumn("tokens", F.transform("tokens", moved)).drop("_before")


def joined_segments(pieces: str = "piece", tokens: str = "tokens") -> Column:
    """The tokens of a chunk's pieces as one array, in order: an aggregate."""
    return F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(pieces, tokens))), lambda x: x[tokens]))
