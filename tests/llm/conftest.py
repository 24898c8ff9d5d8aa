from __future__ import annotations

import pytest

EDGES = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "é"),
    (6, "the quick brown fox jumps over the lazy dog near the old river bank today"),
    (7, "word " * 9000 + "end <|endoftext|> Ünïcödé ΑΣ 漢字 🤗 don't WE'LL 12345 x́"),
    (7, "word " * 9000 + "end <|endoftext|> Ünïcödé ΑΣ 漢字 🤗 don't WE'LL 12345 x́"),
    (8, "x" * 40000),
    (9, "12 34 !!"),
]


@pytest.fixture
def edges(spark):
    """Nulls, blanks, long texts, repeated rows, and columns whose names clash with those that operators add."""
    rows = [(k, t, "en" if k % 2 else None, f"s{k % 3}", 0, "x", True) for k, t in EDGES]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_tokens int, row string, kept boolean")


@pytest.fixture
def nothing(edges):
    return edges.limit(0)
