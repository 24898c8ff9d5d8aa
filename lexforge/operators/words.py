"""Words of texts, one row for each different word of a chunk: the offline tokenizer over Arrow batches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions.keys import APOSTROPHES, is_punctuation

#: What a character is to the tokenizer: a blank, part of a run, a sign that is punctuation, another sign.
BLANK, RUN, MARK, SIGN = range(4)
#: Characters of the texts that are worked on at once; a longer text is taken alone.
SLICE_CHARS = 1 << 20
_codes: dict[str, bytes] = {}


def character_classes(spark: SparkSession) -> bytes:
    """The class of every code point by the same patterns that ``token_list`` has, packed; made once in a session."""
    app = spark.sparkContext.applicationId
    if app not in _codes:
        sign = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        kind = F.when(sign.rlike(r"^[\p{L}\p{M}\p{N}]$"), RUN).when(sign.rlike(r"^[ \t\n\x0b\f\r]$"), BLANK).when(is_punctuation(sign), MARK).otherwise(SIGN)
        rows = spark.range(0, 0x110000, 1, 1).select(kind.cast("tinyint").alias("kind")).toArrow()
        _codes[app] = zlib.compress(rows["kind"].to_numpy().astype(np.uint8).tobytes())
    return _codes[app]


def _texts(chars: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of the given lengths, one behind the other in ``chars`` (code points)."""
    data = chars.tobytes().decode("utf-32-le").encode()
    ends = np.cumsum(lengths)
    if len(data) > len(chars):
        sizes = 1 + (chars >= 0x80).astype(np.int8) + (chars >= 0x800) + (chars >= 0x10000)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[ends]
    offsets = np.concatenate([[0], ends])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))


def _grouped(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array, pa.Array]:
    """(row, text, key_text, seqs, occs) for each different word of each text; occs is null where it counts from 1 on."""
    chars = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    kind = classes[chars]
    run = kind == RUN
    sign = kind > RUN
    starts = np.flatnonzero(sign | (run & ~np.concatenate([[False], run[:-1]])))
    ends = np.flatnonzero(sign | (run & ~np.concatenate([run[1:], [False]]))) + 1
    n = len(starts)
    coded = _texts(chars[kind != BLANK], ends - starts).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    first = np.searchsorted(starts, begins)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(first, n)))
    seq = np.arange(n) - first[owner]
    signs = pc.match_substring_regex(coded.dictionary, f"^[{APOSTROPHES}]+$").to_numpy(zero_copy_only=False)[codes]
    elided = np.append((owner[1:] == owner[:-1]) & (starts[1:] == ends[:-1]) & signs[1:], False)[:n]
    # sorted by text and word, a place less the place where its run begins is the count
    bits = n.bit_length()
    order = np.sort(((owner * max(len(coded.dictionary), 1) + codes) << bits) | np.arange(n)) & ((1 << bits) - 1)
    same = np.concatenate([[False], (owner[order][1:] == owner[order][:-1]) & (codes[order][1:] == codes[order][:-1])])[:n]
    place = np.arange(n)
    occ = place - np.maximum.accumulate(np.where(same, 0, place)) + 1
    word = kind[starts[order]] != MARK
    if elided.any():  # an elided word and one that is not are two words of one text
        again = np.argsort(2 * np.cumsum(~same) + elided[order], kind="stable")
        order, occ, word = order[again], occ[again], word[again]
    order, occ = order[word], occ[word]
    new = np.append(True, (owner[order][1:] != owner[order][:-1]) | (codes[order][1:] != codes[order][:-1]) | (elided[order][1:] != elided[order][:-1]))[: len(order)]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(order)))
    text = coded.dictionary.take(pa.array(codes[order[heads]])).cast(pa.string())
    cut = elided[order[heads]]
    key = pc.if_else(pa.array(cut), pc.binary_join_element_wise(text, "'", ""), text) if cut.any() else text
    told = occ[np.append(heads[1:], len(order)) - 1] != sizes if len(heads) else np.empty(0, bool)
    lists = lambda values, lengths, none=None: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values.astype(np.int32)), mask=none)
    return owner[order[heads]], text, key, lists(seq[order], sizes), lists(occ[np.repeat(told, sizes)], np.where(told, sizes, 0), pa.array(~told))


def grouped_words(chunks: DataFrame, text: str = "primary_text") -> DataFrame:
    """``chunks`` with a row for each different word of the text in its place: text, key_text, and the word's places ``seqs`` and counts ``occs`` in the chunk, in order.

    The tokens are those of ``token_list`` without punctuation, ``seqs`` counts all tokens, and ``occs`` is null where it
    counts from 1 on.  A null text has no words.  Only texts go to Python, and only different words come back.
    """
    keep = [c for c in chunks.columns if c != text]
    packed = character_classes(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.frombuffer(zlib.decompress(packed), np.uint8)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            held, chars, at = [], 0, 0
            for k, raw in enumerate(column):
                held.append((raw.as_py() or b"").decode("utf-8", "replace"))
                chars += len(held[-1]) + 1
                if chars >= SLICE_CHARS or k == len(column) - 1:
                    row, *words = _grouped(held, classes)
                    rows = pa.array(row + at)
                    yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)).take(rows) for c in keep] + words, [*keep, "text", "key_text", "seqs", "occs"])
                    held, chars, at = [], 0, k + 1

    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in chunks.schema if f.name != text)
    return chunks.mapInArrow(run, schema + "text string, key_text string, seqs array<int>, occs array<int>")
