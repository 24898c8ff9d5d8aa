"""Cutting long texts into segments that a model can hold."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.schema import SEGMENT_CHARS

#: What ends a sentence.
BREAKS = (". ", "· ", "· ", "; ", "\n")
_ENDS = regex.compile("|".join(map(regex.escape, BREAKS)))


def cuts(text: str, limit: int = SEGMENT_CHARS) -> list[int]:
    """Where the segments of a text begin: after the last sentence end, or else the last space, in the second half of
    each window, or else at its end."""
    starts = [0]
    while len(text) - starts[-1] > limit:
        low, high = starts[-1] + limit // 2, starts[-1] + limit
        ends = [m.end() for m in _ENDS.finditer(text, low, high, overlapped=True)]
        space = text.rfind(" ", low, high)
        starts.append(max(ends) if ends else space + 1 if space >= 0 else high)
    return starts


def segments(text: Column, limit: int = SEGMENT_CHARS) -> Column:
    """array<struct<char_offset, segment>> whose segments tile the text; a null text has none."""

    def tiles(t: str | None) -> list[dict] | None:
        if t is None:
            return None
        starts = cuts(t, limit)
        return [{"char_offset": a, "segment": t[a:b]} for a, b in zip(starts, [*starts[1:], len(t)], strict=True)]

    @F.pandas_udf("array<struct<char_offset:int,segment:string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(tiles)

    return run(text)
