"""Words grouped by chunk: the same tokens as the tokenizer's, made once for all tables of an index."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexforge.operators import index as indexes
from lexforge.operators import words
from lexforge.plans.tokenize import index_tokens

from test_growth import TEXTS, _chunks

ODD = ["", None, "d' d 'd", "ʼʼ d'ʼ d’", "'", "x", " x\n", "d'd d d'", "é\x85é é"]


@pytest.mark.parametrize("chars", [1, 40, 1 << 20])
def test_grouped_words_are_the_tokenizers(spark, monkeypatch, chars):
    some = random.Random(3)
    texts = ODD + ["".join(some.choices("ab 'ʼ’d.\t\n é𝒳,´΄é‍1₂\x85", k=some.randrange(40))) for _ in range(200)]
    rows = spark.createDataFrame([(k, k, "la", t) for k, t in enumerate(texts)], "doc_id long, chunk_id long, lang string, primary_text string")
    want = indexes._words(index_tokens(rows, True), ["chunk_id"]).select("chunk_id", "text", "key_text", "seq", "occ")
    monkeypatch.setattr(words, "SLICE_CHARS", chars)
    packed = words.grouped_words(rows)
    found = packed.select("chunk_id", "text", "key_text", F.posexplode("seqs").alias("at", "seq"), "occs")
    found = found.select("chunk_id", "text", "key_text", "seq", F.when(F.col("occs").isNull(), F.col("at") + 1).otherwise(F.get("occs", F.col("at"))))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert packed.count() == packed.select("chunk_id", "text", "key_text").distinct().count()


def test_texts_are_tokenized_once_and_tables_stay_the_same(spark, monkeypatch, tmp_path):
    made = []
    keep = indexes.kept
    monkeypatch.setattr(indexes, "kept", lambda df, name, **how: made.append(name) or keep(df, name, **how))
    by_word = indexes.build_index(_chunks(spark, TEXTS), ("la",), tokens=index_tokens)
    grouped = indexes.build_index(_chunks(spark, TEXTS), ("la",), tokens=index_tokens, words=words.grouped_words)
    written = indexes.written_as_read(spark, grouped, str(tmp_path / "index"))
    for name in ("documents", "forms", "form_postings", "form_doc_counts"):
        want = sorted(map(tuple, by_word[name].collect()))
        assert want and sorted(map(tuple, grouped[name].select(by_word[name].columns).collect())) == want
    assert sorted(map(tuple, written["form_postings"].select(by_word["form_postings"].columns).collect())) == sorted(map(tuple, by_word["form_postings"].collect()))
    assert made.count("words") == 1 and made.count("texts") == 1


def test_ends_of_files_are_found_without_a_sort(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 7).alias("form_id"), F.col("id").alias("chunk_id"))
    rows.repartitionByRange(3, "form_id", "chunk_id").sortWithinPartitions("form_id", "chunk_id").write.parquet(str(tmp_path / "t"))
    fences = indexes._fence(spark.read.parquet(str(tmp_path / "t")), ["form_id", "chunk_id"])
    assert "Sort" not in fences._jdf.queryExecution().executedPlan().toString()
    ends = sorted((f["low_id"], f["low_next"], f["high_id"], f["high_next"], f["rows"]) for f in fences.collect())
    assert ends[0][:2] == (0, 0) and ends[-1][2:4] == (6, 993) and sum(e[4] for e in ends) == 1000
