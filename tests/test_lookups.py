"""Look-ups in an index that is not written: the rows of a written one, and no table that they don't need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexforge.operators import index as indexes
from lexforge.operators import search
from lexforge.operators.words import grouped_words
from lexforge.plans.tokenize import index_tokens

TEXTS = ["arma arma, virum Arma", "d' d arma 's", "", "virum; virum d’", None]


def _built(spark):
    rows = [(0, f"a/b/c/v{k % 2}", [k], "la", f"urn:cts:a:b.c.v{k % 2}:{k}", None, None, None, None, text) for k, text in enumerate(TEXTS)]
    chunks = spark.createDataFrame(rows, "root int, version_path string, citation_key array<int>, lang string, urn string, meta_base_urn string, title string, author string, source_repo string, primary_text string")
    rules = lambda kinds: indexes.with_rules(kinds, F.when(F.length("text") >= 2, F.lower("text")), F.lit(None).cast("string"), F.when(F.length("text") >= 4, "Len=Long"))
    return indexes.build_index(chunks, ("la",), tokens=index_tokens, words=grouped_words, rules=rules)


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.fixture
def made(monkeypatch):
    names = []
    keep = indexes.kept
    monkeypatch.setattr(indexes, "kept", lambda df, name: names.append(name) or keep(df, name))
    return names


@pytest.mark.parametrize("pushed", [1000, 0])
def test_look_ups_make_what_they_need(spark, made, monkeypatch, tmp_path, pushed):
    monkeypatch.setattr(indexes, "PUSHED", pushed)
    index = _built(spark)
    arma = search.lookup(index, "forms", "ARMA", "la")
    found = search.postings(index, "form", arma, ("form_id", "chunk_id", "seq", "occ"))
    got = {"postings": _rows(found, "form_id", "chunk_id", "seq", "occ"), "counts": _rows(search.counts_by_document(index, "form", arma), "form_id", "doc_id", "n"), "context": _rows(search.in_context(index, found.select("chunk_id", "seq"), 2), "chunk_id", "seq", "before", "word", "after")}
    got["feats"] = _rows(search.with_feats(index, search.postings(index, "form", arma, ("chunk_id", "seq", "feat_id"))), "chunk_id", "seq", "upos", "feats")
    assert not {"staging", "texts", "lemma", "links"} & set(made)
    lemma = search.lookup(index, "lemmas", "arma", "la")
    got["hits"] = _rows(search.hits(index, search.postings(index, "lemma", lemma, ("form", "chunk_id", "seq", "occ"))), "chunk_id", "seq", "form", "doc_id", "urn")
    got["whole"] = _rows(search.postings(index, "lemma", lemma), *indexes.POSTINGS["lemma_postings"])
    assert "staging" not in made and made.count("words") == 1

    written = indexes.written_as_read(spark, _built(spark), str(tmp_path / "index"))
    arma, lemma = search.lookup(written, "forms", "ARMA", "la"), search.lookup(written, "lemmas", "arma", "la")
    found, of_lemma = search.postings(written, "form", arma), search.postings(written, "lemma", lemma)
    assert got == {
        "postings": _rows(found, "form_id", "chunk_id", "seq", "occ"), "counts": _rows(search.counts_by_document(written, "form", arma), "form_id", "doc_id", "n"), "context": _rows(search.in_context(written, found.select("chunk_id", "seq"), 2), "chunk_id", "seq", "before", "word", "after"),
        "feats": _rows(search.with_feats(written, found), "chunk_id", "seq", "upos", "feats"), "hits": _rows(search.hits(written, of_lemma), "chunk_id", "seq", "form", "doc_id", "urn"), "whole": _rows(of_lemma, *indexes.POSTINGS["lemma_postings"]),
    }
    assert len(got["postings"]) == 4 and len(got["hits"]) == 4


def test_counts_need_no_numbers(spark, made):
    stats = _built(spark).stats.head().asDict()
    assert not {"entries", "form", "lemma", "full"} & set(made)
    assert stats == {"documents": 2, "chunks": 5, "words": 11, "forms": 6, "lemmas": 2, "skipped_chunks": 0}


def test_texts_join_without_a_sort(spark, monkeypatch):
    monkeypatch.setattr(indexes, "PUSHED", 0)
    numbered = spark.range(9).select(F.col("id").cast("string").alias("version"), F.array("id").alias("citation_key"), F.lit("u").alias("urn"), F.col("id").alias("chunk_id"))
    joined = indexes.with_bodies(numbered, numbered.drop("chunk_id").withColumn("primary_text", F.lit("x")))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMerge" not in plan and "Sort [" not in plan
    assert joined.count() == 9


def test_contexts_tokenize_the_asked_texts_alone(spark):
    index = _built(spark)
    asked = index.under["chunk_context"](spark.createDataFrame([(1,)], "chunk_id bigint"))
    assert "Join" not in asked._jdf.queryExecution().optimizedPlan().toString()
    assert _rows(asked, "chunk_id") == [(1,)]
