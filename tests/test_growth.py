"""Steps whose cost must follow the input: what is made, what moves, and what is counted in arrays."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexforge.operators import index as indexes
from lexforge.operators import search
from lexforge.operators.languages import learn_profiles, told_languages
from lexforge.operators.tokens import named_rows, own_texts, token_list
from lexforge.plans import queries
from lexforge.plans.tokenize import index_tokens
from lexforge.sources.sidecars import sliced


def _chunks(spark, texts):
    rows = [(0, "a/b/c/v1", [k], "la", f"urn:cts:a:b.c.v1:{k}", None, None, None, None, text) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "root int, version_path string, citation_key array<int>, lang string, urn string, meta_base_urn string, title string, author string, source_repo string, primary_text string")


def _built(spark, texts):
    rules = lambda kinds: indexes.with_rules(kinds, F.when(F.length("text") >= 2, F.lower("text")), F.lit(None).cast("string"), F.when(F.length("text") >= 4, "Len=Long"))
    return indexes.build_index(_chunks(spark, texts), ("la",), tokens=index_tokens, rules=rules)


TEXTS = ["arma arma, virum Arma", "d' d arma 's", "", "virum; virum d’"]


@pytest.fixture
def made(monkeypatch):
    names = []
    keep = indexes.kept
    monkeypatch.setattr(indexes, "kept", lambda df, name: names.append(name) or keep(df, name))
    return names


def test_dictionaries_are_made_without_postings(spark, made):
    built = _built(spark, TEXTS)
    assert sorted((r["form"], r["key"], r["n"]) for r in built["forms"].collect()) == [("Arma", "arma", 1), ("arma", "arma", 3), ("d", "d", 1), ("d", "d'", 2), ("s", "s", 1), ("virum", "uirum", 3)]
    assert search.lemma_coverage(built).head().asDict() == {"words": 11, "with_lemma": 7, "covered": True}
    assert "staging" not in made and "form" in made
    assert built["form_postings"].count() == 11
    assert "staging" in made


def test_written_tables_are_written_when_asked_for(spark, tmp_path):
    index = indexes.written_as_read(spark, _built(spark, TEXTS), str(tmp_path / "index"))
    assert [r["n"] for r in search.lookup(index, "forms", "VIRUM", "la").collect()] == [3]
    assert sorted(os.listdir(tmp_path / "index")) == ["fences", "forms"]
    found = search.hits(index, search.postings(index, "form", search.lookup(index, "forms", "virum", "la")))
    assert sorted(r["urn"] for r in found.collect()) == ["urn:cts:a:b.c.v1:0@virum[1]", "urn:cts:a:b.c.v1:3@virum[1]", "urn:cts:a:b.c.v1:3@virum[2]"]


def test_kinds_never_share_a_hash(spark, monkeypatch):
    want = sorted(map(tuple, _built(spark, TEXTS)["form_postings"].collect()))
    own, seeds = indexes._kind_hash, []
    monkeypatch.setattr(indexes, "_kind_hash", lambda seed: seeds.append(seed) or (F.lit(7).cast("long") if seed == 0 else own(seed)))
    assert sorted(map(tuple, _built(spark, TEXTS)["form_postings"].collect())) == want
    assert max(seeds) == 1


def test_occurrences_count_by_chunk(spark):
    rows = spark.createDataFrame([(1, "u:1", "a b a a; b"), (2, "u:2", None), (3, None, "a a"), (4, "u:4", "x " * 3000)], "id int, u string, text string").coalesce(1)
    got = named_rows(rows.select("id", "u", token_list(F.col("text")).alias("tokens")), "tokens", "u").collect()
    assert [(r["seq"], r["identifier"], r["urn"]) for r in got if r["id"] == 1] == [(0, "a[1]", "u:1@a[1]"), (1, "b[1]", "u:1@b[1]"), (2, "a[2]", "u:1@a[2]"), (3, "a[3]", "u:1@a[3]"), (4, ";[1]", None), (5, "b[2]", "u:1@b[2]")]
    assert [(r["identifier"], r["urn"]) for r in got if r["id"] == 3] == [("a[1]", None), ("a[2]", None)]
    assert sorted(r["occ"] for r in got if r["id"] == 4) == list(range(1, 3001))


def test_own_texts_strip_and_fall_back(spark):
    text = " μῆνιν \x1f𐍈e"
    tokens = [(0, 7, "model"), (6, 8, " own "), (6, 7, ""), (8, 10, "x"), (7, 8, "y")]
    rows = spark.createDataFrame([(text, tokens), (None, None)], "text string, tokens array<struct<start_char:int,end_char:int,text:string>>")
    got = rows.select(own_texts(F.col("text"), F.col("tokens")).alias("t")).collect()
    assert [t["text"] for t in got[0]["t"]] == ["μῆνιν", "\x1f", "𐍈e", "\x1f"]
    assert got[1]["t"] is None


def test_rows_that_share_an_id_are_one_text(spark):
    """The sums of trigrams of both rows, as one group by id has them."""
    known = spark.createDataFrame([("a", "aab", -100), ("a", "aba", -200), ("a", None, -900), ("b", "bbb", -100), ("b", None, -900)], "lang string, gram string, weight bigint")
    asked = spark.createDataFrame([(1, "aaba"), (1, "aabx"), (2, "BBB"), (3, "ab"), (4, None), (5, "xyz")], "id int, text string")
    assert sorted(map(tuple, told_languages(asked, known, "id").collect())) == [(1, "a", -100 - 200 - 100 - 900), (2, "b", -100), (5, "a", -900)]


def test_trigrams_are_counted_before_they_move(spark):
    """A million equal trigrams are one row of each batch."""
    rows = spark.createDataFrame([("a", "ab" * 1500)] * 300, "lang string, text string").coalesce(1)
    assert {(r["lang"], r["gram"]) for r in learn_profiles(rows).collect()} == {("a", "aba"), ("a", "bab"), ("a", None)}
    plan = learn_profiles(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_python_holds_slices_of_a_batch():
    batch = pa.record_batch({"x": pa.array(range(1300))})
    assert [b.num_rows for b in sliced(iter([batch]))] == [512, 512, 276]
    assert [x for b in sliced(iter([batch])) for x in b.column(0).to_pylist()] == list(range(1300))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_sources_are_scanned_without_a_tree_of_sidecars(spark):
    root = queries.tree(spark, "/root/testdata/sf0.001", "sources").removeprefix("file:")
    assert os.listdir(root) == ["data"]
    assert all(f.endswith(".xml") or f.startswith(".") for _, _, files in os.walk(root) for f in files)
