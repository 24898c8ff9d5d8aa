"""Language ID by compression: each language has a zstandard raw-content dictionary, and the text goes to the language
under whose dictionary it becomes smallest.

Texts and dictionaries are lower-cased, with one space for each run of anything but letters, so that case and noise
between words don't break matches.  A text is compressed in blocks of BLOCK bytes, each under the dictionary alone, and
the sizes are summed: every part of a text of any length is judged by the dictionary and bears on the result alike.
Every block follows a run of zero bytes, whose own size is taken off, so that the compressor does not give up on a short
block as incompressible.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.texts import map_texts, strings

#: The bound of the training sample: different texts of each language, and characters from one place of each.
SAMPLE_DOCS, SAMPLE_CHARS = 256, 256
BLOCK = 512
#: A margin is narrow under so many bytes and so large a share of the size under the next language.  Calibrated on
#: folds 3 and 4 of sf0.1, with dictionaries of folds 1 and 2 (see README).
MARGIN_BYTES, MARGIN_SHARE = 1, 0.025
_PAD = bytes(96)
_PARAMS = {"window_log": 18, "chain_log": 17, "hash_log": 17, "search_log": 4, "min_match": 4, "target_length": 16, "strategy": zstandard.STRATEGY_LAZY2, "write_content_size": 0, "write_checksum": 0, "write_dict_id": 0}
_LETTER = regex.compile(r"\p{L}")
_OTHER = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    """The letters of a text in lower case, words parted by one space."""
    return _OTHER.sub(" ", text.lower()).encode()


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """A dictionary for each language that has a labelled text with a letter outside fold 0.

    It is made of ``chars`` characters from each of the ``docs`` different whole texts whose hashes come first, however
    often each is repeated, at a place that the hash draws from the whole text (all of a shorter one).  Nothing else
    bounds it, so a language with fewer different texts has all of them in the sample.
    """
    rows = df.filter((fold(F.col(id_col)) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    some = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(text_col).cast("string")).alias("at"), F.col(text_col).cast("string").alias("text"))
    # hashes first, without copies: of the texts, only those up to the last hash that is needed are looked at again
    first = some.select("lang", "at").distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("at"))).filter(F.col("k") <= docs)
    upto = {r["lang"]: r["at"] for r in first.groupBy("lang").agg(F.max("at").alias("at")).collect()}  # one row for each language
    if not upto:
        return {}
    last = F.create_map(*[x for lang, at in upto.items() for x in (F.lit(lang), F.lit(at))])
    place = F.pmod("at", F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int")
    piece = F.substring(F.col("text"), place + 1, F.lit(chars))
    picked = some.filter(F.col("at") <= F.element_at(last, F.col("lang"))).groupBy("lang", "at").agg(F.min(piece).alias("piece")).orderBy("lang", "at").collect()
    out: dict[str, bytes] = {}
    for r in picked:  # ``docs`` rows for each language
        out[r["lang"]] = out.get(r["lang"], b"") + plain(r["piece"]) + b"\n"
    return out


class Classifier:
    """Sizes of a text under every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.coders = []
        for lang in self.langs:
            p = zstandard.ZstdCompressionParameters(**_PARAMS)
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            self.coders.append(zstandard.ZstdCompressor(compression_params=p, dict_data=d))
        self.base = [len(c.compress(_PAD)) for c in self.coders]

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes under each dictionary, one at least."""
        raw = plain(text)
        blocks = [_PAD + raw[a : a + BLOCK] for a in range(0, len(raw), BLOCK)]
        return [max(1, sum([len(c.compress(b)) for b in blocks]) - base * len(blocks)) for c, base in zip(self.coders, self.base, strict=True)]

    def judged(self, text: str | None) -> tuple[str, float, int, bool]:
        """Language, score, how many bytes the next language needs more, and whether that margin is wide enough.

        ``und`` without letters or languages; a single language has no margin to be compared with, and it is wide.
        """
        if not text or not self.langs or not _LETTER.search(text):
            return "und", 0.0, 0, False
        sizes = np.array(self.sizes(text))
        best = int(sizes.argmin())
        if len(sizes) == 1:
            return self.langs[0], 1.0, int(sizes[0]), True
        second = int(np.partition(sizes, 1)[1])
        margin = second - int(sizes[best])
        return self.langs[best], min(1.0, 4.0 * margin / second), margin, margin >= MARGIN_BYTES + MARGIN_SHARE * second


def identify(df: DataFrame, dictionaries: dict[str, bytes], min_margin: int = 1, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """One row (doc_id, lang_pred, score, margin, accepted) for each row of ``df``, with the columns ``keep`` carried along.

    A text without letters, a null or an empty one is ``und``.  A prediction is rejected (``accepted`` false) where it is
    ``und``, or its margin is narrow for the size of the text or under ``min_margin`` bytes.  Ties go to the language that
    sorts first and are rejected.  Repeated rows give repeated results, an empty table an empty one; only id, text and
    ``keep`` are read.
    """
    kept = df.select(F.col(id_col).alias("doc_id"), *keep).schema.fields[1:]
    own = T.StructType().add("lang_pred", "string").add("score", "double").add("margin", "long").add("accepted", "boolean").fields
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *kept, *own])
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)
    state: dict[str, Classifier] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if "c" not in state:
                state["c"] = Classifier(shared.value)
            got = [state["c"].judged(t) for t in strings(batch.column(1))]
            more = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.int64()), pa.array([g[3] and g[2] >= min_margin for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *batch.columns[2:], *more], names=["doc_id", *[f.name for f in kept], "lang_pred", "score", "margin", "accepted"])

    return map_texts(df, run, schema, id_col, text_col, keep)
