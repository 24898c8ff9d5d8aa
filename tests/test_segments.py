from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexforge.functions.segments import cuts, segments


def plain(text: str, limit: int) -> list[int]:
    """The rule, looked for from the end of every window."""
    out = [0]
    while len(text) - out[-1] > limit:
        low, high = out[-1] + limit // 2, out[-1] + limit
        best = 0
        for at in range(low, high):
            for mark in (". ", "· ", "· ", "; ", "\n"):
                if text[at : at + len(mark)] == mark and at + len(mark) <= high:
                    best = max(best, at + len(mark))
        if not best:
            best = max((at + 1 for at in range(low, high) if text[at] == " "), default=high)
        out.append(best)
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. ;·\n", max_size=200), st.integers(4, 40))
def test_cuts_follow_the_rule(text, limit):
    got = cuts(text, limit)
    assert got == plain(text, limit)
    ends = [*got[1:], len(text)]
    assert "".join(text[a:b] for a, b in zip(got, ends, strict=True)) == text
    assert all(b - a <= limit for a, b in zip(got, ends, strict=True))


def test_segments_tile_the_text(spark):
    text = "μῆνιν ἄειδε θεά. " * 40 + "x" * 300 + " καὶ τὰ λοιπά" * 30
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, t string")
    got = {r["k"]: r["s"] for r in df.select("k", segments(F.col("t"), 100).alias("s")).collect()}
    assert "".join(s["segment"] for s in got[1]) == text
    assert all(len(s["segment"]) <= 100 and text[s["char_offset"] :].startswith(s["segment"]) for s in got[1])
    assert got[1][0]["segment"].endswith(". ")
    assert got[2] is None and [s["segment"] for s in got[3]] == [""]
