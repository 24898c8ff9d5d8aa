"""Tokenizing chunks: pluggable analyzers behind one Arrow operator, and a native plan for the offline tokenizer."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import partial
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.names import language_sample
from lexforge.functions.segments import segments
from lexforge.operators.tokens import joined_segments, named_tokens, occurrences, own_texts, shift_segments, token_list
from lexforge.schema import LANGID_SAMPLE_CHARS, SEGMENT_CHARS, TOKEN


class Analyzer(Protocol):
    """A model behind the tokenizer; made anew in every Python worker."""

    def language(self, texts: list[str]) -> list[str]:
        """Language codes of (samples of) texts."""

    def tokens(self, lang: str, segments: list[str]) -> list[list[dict]]:
        """Token dicts (start_char, end_char, id, text, whitespace, words, ner) of each segment, in its own coordinates."""


#: What a model gets at once: so many pieces at most, of so many characters together (one piece may have more).
BATCH_PIECES, BATCH_CHARS = 256, 1 << 18


def batches(sizes: list[int], most: int = BATCH_PIECES, chars: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``most`` texts and ``chars`` characters, but of one text at least."""
    start = held = 0
    for k, n in enumerate(sizes):
        if k > start and (k - start >= most or held + n > chars):
            yield start, k
            start, held = k, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def _each(run: Callable[[list], list], items: list) -> tuple[list, list[str | None]]:
    """``run`` over all items at once, or where that fails one by one: results (None for a failure), and errors."""
    try:
        return list(run(items)), [None] * len(items)
    except Exception:
        out, errors = [], []
        for x in items:
            try:
                out += run([x])
                errors.append(None)
            except Exception as e:
                out.append(None)
                errors.append(str(e))
        return out, errors


def _languages(model: Callable[[], Analyzer], deadline: float | None) -> Callable[[Column], Column]:
    """struct<lang, error, late> of texts; blank ones have no language."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = model()
        for seen in series:
            texts = seen.fillna("").tolist()
            langs, errors, late = [""] * len(texts), [None] * len(texts), [False] * len(texts)
            for a, b in batches([len(t) for t in texts]):
                if deadline is not None and time.time() >= deadline:
                    late[a:b] = [True] * (b - a)
                    continue
                full = [k for k in range(a, b) if texts[k].strip()]
                for k, lang, error in zip(full, *_each(own.language, [texts[k] for k in full]), strict=True):
                    langs[k], errors[k] = lang or "", None if error is None else f"language: {error}"
            yield pd.DataFrame({"lang": langs, "error": errors, "late": late})

    # a plain annotation in text form would not be understood by pandas_udf
    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang string, error string, late boolean").asNondeterministic()


def _pieces_analyzed(pieces: DataFrame, model: Callable[[], Analyzer], deadline: float | None) -> DataFrame:
    """``pieces`` with tokens, in the coordinates of the piece; a failure stays with its piece, what comes past the deadline is late."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + f", tokens array<{TOKEN}>"

    def analyzed(df: pd.DataFrame, own: Analyzer) -> pd.DataFrame:
        tokens, errors = [[] for _ in range(len(df))], df["error"].tolist()
        if deadline is not None and time.time() >= deadline:
            return df.assign(late=True, tokens=tokens)
        todo: dict[str, list[int]] = {}
        for k, (text, lang, error, late) in enumerate(zip(df["segment"], df["lang"], errors, df["late"], strict=True)):
            if error is None and not late and text.strip():
                todo.setdefault(lang, []).append(k)
        texts = df["segment"].tolist()
        for lang, members in sorted(todo.items()):
            found, failed = _each(partial(own.tokens, lang), [texts[k] for k in members])
            for k, t, e in zip(members, found, failed, strict=True):
                tokens[k], errors[k] = t or [], e
        return df.assign(error=errors, tokens=tokens)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = model()
        for df in frames:
            df = df.astype({"error": object}).where(df.notna(), None)
            for a, b in batches(df["segment"].str.len().tolist()):
                yield analyzed(df.iloc[a:b], own)

    return pieces.mapInPandas(run, schema)


def analyze_chunks(chunks: DataFrame, model: Callable[[], Analyzer], sample: bool = True, segment_chars: int | None = SEGMENT_CHARS, parts: int | None = None, deadline: float | None = None) -> DataFrame:
    """Rows (version_path, chunk_name, sha, urn, lang, raw, error, deferred) from (version_path, chunk_name, sha, urn, primary_text).

    The language comes from a bounded sample (or the whole text).  Texts are cut into segments, which are rows of their
    own and dealt out, so that one long text keeps many tasks busy; a model gets bounded batches of segments of one
    language.  A chunk with a failed segment has its error, and one that isn't ready at ``deadline`` (time.time) is
    deferred; tasks work in the order of the chunks, so that most are either ready or not begun.  Blank texts have no
    language and no tokens; repeated rows are chunks of their own.
    """
    spark = chunks.sparkSession
    seen = language_sample(F.col("primary_text"), LANGID_SAMPLE_CHARS) if sample else F.col("primary_text")
    text = F.coalesce("primary_text", F.lit(""))
    cut = segments(text, segment_chars) if segment_chars else F.array(F.struct(F.lit(0).alias("char_offset"), text.alias("segment")))
    rows = chunks.select(F.monotonically_increasing_id().alias("row"), "version_path", "chunk_name", "sha", "urn", "primary_text").withColumn("_l", _languages(model, deadline)(seen))
    rows = rows.select("row", "version_path", "chunk_name", "sha", "urn", "_l.lang", "_l.error", "_l.late", F.posexplode(cut).alias("piece", "_s")).select("*", "_s.char_offset", "_s.segment").drop("_s")
    dealt = rows.repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), "row", "piece").sortWithinPartitions("row", "piece")
    done = _pieces_analyzed(dealt, model, deadline)
    done = done.withColumn("tokens", own_texts(F.col("segment"), F.col("tokens"))).drop("segment")
    whole = shift_segments(done, ["row"], getattr(model(), "ids_count_along", True)).groupBy("row")
    same = [F.first(c).alias(c) for c in ("version_path", "chunk_name", "sha", "urn", "lang")]
    out = whole.agg(*same, joined_segments().alias("raw"), F.min_by("error", F.when(F.col("error").isNotNull(), F.col("piece"))).alias("error"), F.max("late").alias("deferred"))
    return out.drop("row")


def finish(analyzed: DataFrame) -> DataFrame:
    """Sidecar rows (version_path, chunk_name, sha, urn, lang, tokens) of analyzed chunks that are ready, named in their arrays."""
    good = analyzed.filter(F.col("error").isNull() & ~F.col("deferred"))

    def token(z: Column) -> Column:
        t, n = z["t"], z["n"]
        return F.struct(*[t[c].alias(c) for c in ("start_char", "end_char", "id")], F.lit(None).cast("string").alias("misc"), *[t[c].alias(c) for c in ("ner", "text", "whitespace", "words")], n["identifier"].alias("identifier"), n["urn"].alias("urn"))

    named = F.transform(F.arrays_zip(F.col("raw").alias("t"), named_tokens(F.col("raw"), F.col("urn")).alias("n")), token)
    return good.select("version_path", "chunk_name", "sha", "urn", "lang", named.alias("tokens"))


def tokenize_native(chunks: DataFrame, keep: list[str], lemma: Callable[[Column], Column] | None = None, upos: Callable[[Column], Column] | None = None, feats: Callable[[Column], Column] | None = None, text: str = "primary_text") -> DataFrame:
    """Sidecar rows of the offline tokenizer, one for each row of ``chunks``, without a shuffle: ``keep``, urn and tokens (text, whitespace, identifier, urn, words).

    It knows no morphology; ``lemma``, ``upos`` and ``feats`` are expressions over a word's text that a caller may give
    (a dictionary is joined later, in ``build_index``).  A null or blank text has no tokens; tokens of a chunk without a
    URN have identifiers only; repeated rows are chunks of their own.
    """
    none = F.lit(None).cast("string")

    def token(t: Column) -> Column:
        given = [F.when(t["urn"].isNotNull(), none if f is None else f(t["text"])).alias(name) for name, f in (("lemma", lemma), ("upos", upos), ("feats", feats))]
        return F.struct(t["text"].alias("text"), t["whitespace"].alias("whitespace"), t["identifier"].alias("identifier"), t["urn"].alias("urn"), F.array(F.struct(*given)).alias("words"))

    return chunks.select(*keep, "urn", token_list(F.col(text)).alias("tokens")).select(*keep, "urn", F.transform(named_tokens(F.col("tokens"), F.col("urn")), token).alias("tokens"))


def index_tokens(chunks: DataFrame, counted: bool, text: str = "primary_text") -> DataFrame:
    """``chunks`` with the offline tokenizer's tokens in place of their text, as ``build_index`` reads them: text, whitespace, and occ where ``counted``."""
    keep = [c for c in chunks.columns if c != text]
    rows = chunks.select(*keep, token_list(F.col(text)).alias("tokens"))
    if not counted:
        return rows
    both = F.arrays_zip(F.col("tokens").alias("t"), occurrences(F.col("tokens")).alias("occ"))
    return rows.select(*keep, F.transform(both, lambda z: F.struct(z["t"]["text"].alias("text"), z["t"]["whitespace"].alias("whitespace"), z["occ"].alias("occ"))).alias("tokens"))
