from __future__ import annotations

import json
import sys
import time
from functools import partial

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lexforge.operators.incremental import compile_status, missing_works, plan_chunks, split_failures, stale_sidecars
from lexforge.plans import pipeline
from lexforge.plans.analyzers import PlainAnalyzer
from lexforge.plans.tokenize import analyze_chunks, finish
from lexforge.sources.storage import kept
from lexforge.sources.tei import _has_element, read_chunk

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import test modules
greek = partial(PlainAnalyzer, "grc")
VERSIONS = {"spacy": "1", "stanza": "2", "la_core_web_lg": "3", "grc_dep_web_lg": "4"}
TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><title>{t}</title><refsDecl>{cite}</refsDecl></teiHeader>
<text><body xml:base="{base}"><div n="1"><p>{one}</p></div><div n="2"><p>arma virumque cano</p></div></body></text></TEI>"""


def source(root, name, base, one="μῆνιν ἄειδε, θεά", cite="<citeStructure/>"):
    place = root / "data" / name
    place.parent.mkdir(parents=True, exist_ok=True)
    place.write_text(TEI.format(t=name, base=base, one=one, cite=cite), encoding="utf-8")


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "corpus"
    source(root, "a/good.xml", "urn:cts:greekLit:tlg1.tlg2.grc1")
    source(root, "a/badbase.xml", "good.xml")
    source(root, "a/plain.xml", "urn:cts:greekLit:tlg1.tlg3.grc1", cite="")
    source(root, "a/__cts__.xml", "urn:cts:greekLit:x.y.z")
    (root / "data/a/broken.xml").write_text("<TEI><citeStructure/><body>", encoding="utf-8")
    return root


def test_whole_run_and_index(spark, corpus, tmp_path):
    store = pipeline.Store(spark, str(tmp_path / "store"))
    late = pipeline.run(spark, str(corpus), pipeline.Store(spark, str(tmp_path / "late")), greek, VERSIONS, time_budget_minutes=0)
    assert late["statuses"]["compiled"] == 1 and late["tokenize"] == {"generated": 0, "skipped": 0, "failed": 0, "deferred": 2, "pruned": 0}
    record = pipeline.run(spark, str(corpus), store, greek, VERSIONS)
    status = {w["path"]: w["status"] for w in spark.read.json(record["works"]).collect()}
    assert record["statuses"] == {"compiled": 1, "failed": 2, "no-citestructure": 1}
    assert status == {"data/a/good.xml": "compiled", "data/a/badbase.xml": "failed", "data/a/plain.xml": "no-citestructure", "data/a/broken.xml": "failed"}
    assert record["tokenize"] == {"generated": 2, "skipped": 0, "failed": 0, "deferred": 0, "pruned": 0} and record["exit_status"] == 1
    again = pipeline.run(spark, str(corpus), store, greek, VERSIONS)
    assert set(again["statuses"]) == {"skipped", "failed", "no-citestructure"} and again["tokenize"]["skipped"] == 2
    built, manifest = pipeline.index(spark, [store], str(tmp_path / "out"))
    assert (manifest["documents"], manifest["chunks"], manifest["words"]) == (1, 2, 6)
    assert built["documents"].head()["base_urn"] == "urn:cts:greekLit:tlg1.tlg2.grc1"


def test_incremental(spark, corpus, tmp_path):
    store = pipeline.Store(spark, str(tmp_path / "store"))
    pipeline.compile_corpus(spark, str(corpus), store)
    assert pipeline.tokenize(spark, store, greek, VERSIONS, deadline=time.monotonic())["deferred"] == 2
    assert pipeline.tokenize(spark, store, greek, VERSIONS)["generated"] == 2
    assert pipeline.tokenize(spark, store, greek, VERSIONS)["skipped"] == 2
    time.sleep(1.1)
    source(corpus, "a/good.xml", "urn:cts:greekLit:tlg1.tlg2.grc1", one="other words")
    pipeline.compile_corpus(spark, str(corpus), store, force=True)
    counts = pipeline.tokenize(spark, store, greek, VERSIONS, batch=1)
    assert (counts["generated"], counts["skipped"]) == (1, 1)
    assert pipeline.tokenize(spark, store, greek, VERSIONS | {"spacy": "2"})["generated"] == 2
    store.write("chunks", store.read("chunks", pipeline.CHUNKS).filter("chunk_name = '1.xml'"))
    assert pipeline.prune_stale(store) == 1 and pipeline.prune_stale(store) == 0
    assert store.read("sidecars", pipeline.SIDECARS).count() == 1


def test_a_crash_between_two_steps_loses_nothing(spark, tmp_path, monkeypatch):
    store = pipeline.Store(spark, str(tmp_path / "store"))
    row = lambda v, n: spark.createDataFrame([(v, n, "s", "grc", "p")], pipeline.MANIFEST)
    store.write("manifest", row("a", "1"))
    store.append("manifest", row("b", "2"))

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "put_new_text", crash)
        for step in (store.write, store.append):
            with pytest.raises(OSError):
                step("manifest", row("c", "3"))
    left = lambda: sorted(r["version_path"] for r in store.read("manifest", pipeline.MANIFEST).collect())
    assert left() == ["a", "b"]
    with monkeypatch.context() as m:  # after the pointer, before old parts are removed
        m.setattr(pipeline, "remove", crash)
        with pytest.raises(OSError):
            store.append("manifest", row("c", "3"))
    assert left() == ["a", "b", "c"]
    store.append("manifest", row("b", "2").withColumn("sha", F.lit("new")))
    assert left() == ["a", "b", "c"] and store.read("manifest", pipeline.MANIFEST).filter("sha = 'new'").count() == 1
    before = store.read("manifest", pipeline.MANIFEST)
    store.write("manifest", row("d", "4"))
    assert before.count() == 3 and left() == ["d"]
    for pointer in (tmp_path / "store/manifest.current").glob("*"):
        pointer.unlink()
    with pytest.raises(FileNotFoundError):
        left()


def test_parts_are_merged_in_levels(spark, tmp_path, monkeypatch):
    """The newest row of a key counts through all merges, and a read is two scans however many parts there are."""
    monkeypatch.setattr(pipeline, "FANOUT", 3)
    store, want = pipeline.Store(spark, str(tmp_path / "store")), {}
    for k in range(14):
        store.append("manifest", spark.createDataFrame([(f"v{k % 5}", "1", str(k), "la", "p"), (f"w{k}", "1", str(k), "la", "p")], pipeline.MANIFEST))
        want |= {f"v{k % 5}": str(k), f"w{k}": str(k)}
        levels = [level for _, level in store.parts("manifest")]
        assert levels == sorted(levels, reverse=True) and max(map(levels.count, levels)) < 3
    rows = store.read("manifest", pipeline.MANIFEST)
    got = [(r["version_path"], r["sha"]) for r in rows.collect()]
    assert dict(got) == want and len(got) == len(want)
    assert levels == [2, 1, 0, 0] and len(rows._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("|").split("|")) == 2
    assert len([p for p in (tmp_path / "store/manifest").iterdir() if not p.name.startswith(".")]) <= len(levels) + 3


def test_a_run_without_changes_writes_no_text(spark, corpus, tmp_path, monkeypatch):
    store = pipeline.Store(spark, str(tmp_path / "store"))
    pipeline.compile_corpus(spark, str(corpus), store)
    assert pipeline.tokenize(spark, store, greek, VERSIONS)["generated"] == 2
    written = []
    monkeypatch.setattr(pipeline, "kept", lambda df, name: written.append(df.columns) or kept(df, name))
    assert pipeline.tokenize(spark, store, greek, VERSIONS)["skipped"] == 2
    assert written and not any("primary_text" in c for c in written)


def test_small_files_are_replaced(spark, tmp_path):
    from lexforge.sources.storage import get_text, put_new_text, put_text

    path = str(tmp_path / "x/manifest.json")
    for text in ("one", "zwei é"):
        put_text(spark, path, text)
        assert get_text(spark, path) == text
    with pytest.raises(FileExistsError):
        put_new_text(spark, path, "three")
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["manifest.json"]


def test_analysis_skips_what_is_there(spark, corpus, tmp_path):
    store = pipeline.Store(spark, str(tmp_path / "store"))
    pipeline.compile_corpus(spark, str(corpus), store)
    assert pipeline.analyze(spark, store, greek) == {"generated": 2, "failed": 0, "skipped": 0}
    assert pipeline.analyze(spark, store, greek) == {"generated": 0, "failed": 0, "skipped": 2}
    assert store.read("manifest", "version_path string, chunk_name string, sha string, lang string, pipeline string").count() == 0


class Flaky(PlainAnalyzer):
    def tokens(self, lang, segments):
        if any("boom" in s for s in segments):
            raise RuntimeError("boom")
        return super().tokens(lang, segments)

    def language(self, texts):
        if any("lost" in t for t in texts):
            raise RuntimeError("lost")
        return super().language(texts)


def test_failures_stay_with_their_chunk(spark):
    data = [("v", f"{k}.xml", "s", f"urn:{k}", t) for k, t in enumerate(["one two", "boom", "", None, "lost here", "three"])]
    df = spark.createDataFrame(data, "version_path string, chunk_name string, sha string, urn string, primary_text string").coalesce(1)
    got = analyze_chunks(df, lambda: Flaky("la")).persist()
    assert {r["chunk_name"]: r["error"] for r in got.collect() if r["error"]} == {"1.xml": "boom", "4.xml": "language: lost"}
    done = {r["chunk_name"]: [t["identifier"] for t in r["tokens"]] for r in finish(got).collect()}
    assert done == {"0.xml": ["one[1]", "two[1]"], "2.xml": [], "3.xml": [], "5.xml": ["three[1]"]}


def test_segmented_equals_whole(spark):
    text = "arma virumque cano. " * 30 + "Troiae qui primus; " * 20
    df = spark.createDataFrame([("v", "1.xml", "s", "u", text)], "version_path string, chunk_name string, sha string, urn string, primary_text string")
    whole, cut = (finish(analyze_chunks(df, greek, segment_chars=n)).head()["tokens"] for n in (None, 100))
    assert whole == cut and [t["id"] for t in cut] == [[k] for k in range(len(cut))]


def test_plans(spark):
    chunks = spark.createDataFrame([("v", "1.xml", "a"), ("v", "2.xml", "b"), ("v", "3.xml", "c")], "version_path string, chunk_name string, sha string")
    manifest = spark.createDataFrame([("v", "1.xml", "a", "he", "2:stanza-2:tokenize"), ("v", "2.xml", "b", "he", "1:x"), ("v", "3.xml", "c", "he", "2:stanza-2:tokenize"), ("gone", "1.xml", "a", "he", "x")], "version_path string, chunk_name string, sha string, lang string, pipeline string")
    sidecars = spark.createDataFrame([("v", "1.tokens.json.zst"), ("v", "2.tokens.json.zst"), ("v", "9.tokens.json.zst")], "version_path string, sidecar string")
    assert {r["chunk_name"] for r in plan_chunks(chunks, manifest, sidecars, VERSIONS).filter("up_to_date").collect()} == {"1.xml"}
    assert plan_chunks(chunks, manifest, sidecars, VERSIONS, force=True).filter("up_to_date").isEmpty()
    assert [r["sidecar"] for r in stale_sidecars(sidecars, chunks).collect()] == ["9.tokens.json.zst"]
    assert [r["version_path"] for r in missing_works(manifest, chunks).collect()] == ["gone"]
    good, bad = split_failures(spark.createDataFrame([(1, None), (2, "x")], "k int, error string"))
    assert (good.count(), bad.count()) == (1, 1)


def test_compile_status(spark):
    rows = [(1, True, None, "urn:cts:a:b", True, 10), (2, True, None, "urn:cts:a:c", True, 10), (3, False, None, "", False, 10), (4, True, "bad", "", False, 10), (5, True, None, "x", False, 10)]
    df = spark.createDataFrame(rows, "k int, has_structure boolean, error string, base_urn string, urn_ok boolean, modified int")
    done = spark.createDataFrame([("urn:cts:a:b", 10), ("urn:cts:a:c", 9)], "base_urn string, compiled_at int")
    assert [r["status"] for r in compile_status(df, done).orderBy("k").collect()] == ["skipped", "pending", "no-citestructure", "failed", "failed"]


def test_elements_in_broken_markup():
    assert _has_element(b'<!DOCTYPE TEI SYSTEM "x.dtd"><t:a xmlns:t="u"><t:citeStructure/></t:a>', "citeStructure")
    assert _has_element("<a><br><citeStructure></a>", "citeStructure")
    assert not _has_element("<a><!-- <citeStructure/> --></b>", "citeStructure")
    assert not _has_element(b"", "citeStructure") and not _has_element("<citeStructures/>", "citeStructure")


def test_chunk_files(spark):
    xml = ['<c cts_urn="a:b:1"><elements>x <w>y</w> z</elements></c>', '<c cts_urn="a:b:1" base_urn="q"><elements/></c>', '<c cts_urn="a:b:1"><text/></c>', "<c", None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(xml)], "k int, x string")
    got = [r["c"] for r in df.select("k", read_chunk(F.col("x")).alias("c")).orderBy("k").collect()]
    assert (got[0]["primary_text"], got[0]["base_urn"], got[1]["base_urn"], got[1]["primary_text"]) == ("x y z", "a:b", "q", "")
    assert all(g["error"] and g["primary_text"] is None for g in got[2:])


def test_stream_takes_new_files_once(spark, tmp_path):
    from lexforge.streaming.ingest import ingest, register_functions

    schema = "version_path string, chunk_name string, urn string, primary_text string"
    for k in (1, 2):
        spark.createDataFrame([("v", f"{k}.xml", f"u:{k}", "a b")], schema).write.mode("append").parquet(str(tmp_path / "in"))
        ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == k
    register_functions(spark)
    assert spark.sql("SELECT match_key('δὲ', 'grc') AS k, loose_key('Juno', 'la') AS l").head() == ("δέ", "iuno")


def test_command_line(spark, corpus, tmp_path, capsys):
    from lexforge.plans.cli import main

    base, out = str(tmp_path / "base"), str(tmp_path / "out")
    assert main(["pipeline", "--corpus-root", str(corpus), "--base", base, "--plain-lang", "grc"], spark) == 1  # two files fail
    assert main(["tokenize", "--base", base, "--plain-lang", "grc", "--prune"], spark) == 0
    assert main(["index", "--base", base, "--out", out, "--source", "a=b"], spark) == 0
    assert '"skipped": 2' in capsys.readouterr().out
    assert main(["check", out], spark) == 1  # the offline tokenizer has no lemmas
    # the sidecars as a tree of files, and an index of such a tree
    files = str(tmp_path / "files")
    assert main(["tokenize", "--base", base, "--plain-lang", "grc", "--tokens-dir", files], spark) == 0
    spark.createDataFrame([("ἄειδε", "grc", "ἀείδω", None, None)], "text string, lang string, lemma string, upos string, feats string").write.parquet(str(tmp_path / "lemmas"))
    assert main(["index", "--tokens-dir", files, "--out", str(tmp_path / "out2"), "--lemma-map", str(tmp_path / "lemmas")], spark) == 0
    made = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (made["documents"], made["chunks"], made["words"], made["lemmas"], made["broken_sidecars"]) == (1, 2, 6, 1, 0)
    assert main(["tokenize", "--base", base, "--analyzer", "lexforge.plans.analyzers:PlainAnalyzer", "--force"], spark) == 0


CHUNK = "version_path string, chunk_name string, sha string, urn string, primary_text string"


def test_a_very_long_chunk_is_dealt_out_and_finalised_in_its_array(spark):
    """200,000 words in one chunk: segments reach several tasks, and the result equals counts made in plain Python."""
    words = [f"w{k % 997}" for k in range(200_000)]
    df = spark.createDataFrame([("v", "1.xml", "s", "urn:x", " ".join(words))], CHUNK)
    began = time.time()
    tokens = finish(analyze_chunks(df, greek, parts=4)).select(F.explode("tokens").alias("t")).select("t.identifier", "t.urn", "t.start_char", F.col("t.id")[0].alias("id")).collect()
    assert time.time() - began < 60
    seen, at, want = {}, 0, []
    for k, w in enumerate(words):
        seen[w] = seen.get(w, 0) + 1
        want.append((f"{w}[{seen[w]}]", f"urn:x@{w}[{seen[w]}]", at, k))
        at += len(w) + 1
    assert [tuple(t) for t in tokens] == want


class Counting(PlainAnalyzer):
    """Fails where it gets more than a batch may hold."""

    def tokens(self, lang, segments):
        if len(segments) > 256 or (len(segments) > 1 and sum(map(len, segments)) > 1 << 18):
            raise RuntimeError("too much at once")
        return super().tokens(lang, segments)

    def language(self, texts):
        if len(texts) > 256:
            raise RuntimeError("too many at once")
        return super().language(texts)


def test_batches_are_bounded(spark):
    from lexforge.plans.tokenize import batches

    assert list(batches([])) == [] and list(batches([9], 2, 5)) == [(0, 1)]
    assert list(batches([1, 1, 1, 9, 1, 3, 3], 2, 5)) == [(0, 2), (2, 3), (3, 4), (4, 6), (6, 7)]
    df = spark.range(2000).select(F.lit("v").alias("version_path"), F.col("id").cast("string").alias("chunk_name"), F.lit("s").alias("sha"), F.lit("u").alias("urn"), F.repeat(F.lit("word and "), 60).alias("primary_text"))
    got = analyze_chunks(df.coalesce(1), lambda: Counting("la"), parts=1)
    assert got.filter("error is not null").isEmpty() and got.agg(F.sum(F.size("raw"))).head()[0] == 2000 * 120


class Slow(PlainAnalyzer):
    def tokens(self, lang, segments):
        time.sleep(0.4)
        return super().tokens(lang, segments)


def test_a_deadline_inside_a_batch_defers_the_rest_and_a_later_run_goes_on(spark, tmp_path):
    store = pipeline.Store(spark, str(tmp_path / "store"))
    rows = spark.range(3000).select(F.concat(F.lit("v"), (F.col("id") % 7).cast("string")).alias("version_path"), F.col("id").cast("int").alias("ord"), F.concat(F.col("id").cast("string"), F.lit(".xml")).alias("chunk_name"), F.lit("urn:a:b").alias("urn"), F.concat_ws(" ", F.lit("word"), F.col("id").cast("string"), F.repeat(F.lit("x "), 400)).alias("primary_text")).withColumn("sha", F.sha2("primary_text", 256))
    store.append("chunks", rows)
    counts = pipeline.tokenize(spark, store, lambda: Slow("la"), VERSIONS, deadline=time.monotonic() - 1)
    assert (counts["generated"], counts["deferred"]) == (0, 3000)
    began = time.monotonic()
    counts = pipeline.tokenize(spark, store, lambda: Slow("la"), VERSIONS, deadline=began + 8)
    assert counts["failed"] == 0 and counts["generated"] + counts["deferred"] == 3000
    rest = pipeline.tokenize(spark, store, greek, VERSIONS)
    assert rest["generated"] == counts["deferred"] and rest["skipped"] == counts["generated"]
    sidecars = store.read("sidecars", pipeline.SIDECARS)
    assert sidecars.count() == sidecars.select("version_path", "chunk_name").distinct().count() == 3000


def test_an_unchanged_corpus_opens_no_file(spark, corpus, tmp_path, monkeypatch):
    """A second run lists; after an edit one file is opened, and statuses stay those of the first run."""
    from pyspark.sql import DataFrameReader

    store = pipeline.Store(spark, str(tmp_path / "store"))
    first = {r["path"]: r["status"] for r in pipeline.compile_corpus(spark, str(corpus), store).collect()}
    assert set(first.values()) == {"compiled", "failed", "no-citestructure"}
    opened = []
    load = DataFrameReader.load
    monkeypatch.setattr(DataFrameReader, "load", lambda self, path=None, **k: (opened.extend(path) if isinstance(path, list) else None) or load(self, path, **k))
    again = {r["path"]: (r["status"], r["reason"]) for r in pipeline.compile_corpus(spark, str(corpus), store).collect()}
    assert {p: s for p, (s, _) in again.items()} == {p: "skipped" if s == "compiled" else s for p, s in first.items()} and not opened
    assert "CTS" in again["data/a/badbase.xml"][1]
    time.sleep(1.1)
    source(corpus, "a/good.xml", "urn:cts:greekLit:tlg1.tlg2.grc1", one="longer than it was before")
    rows = {r["path"]: r for r in pipeline.compile_corpus(spark, str(corpus), store).collect()}
    assert [p.rsplit("/", 1)[1] for p in opened] == ["good.xml"] and rows["data/a/good.xml"]["status"] == "compiled" and rows["data/a/good.xml"]["chunk_count"] == 2
    assert {r["primary_text"].strip() for r in store.read("chunks", pipeline.CHUNKS).collect()} == {"longer than it was before", "arma virumque cano"}


def chunk_tree(root, version, texts, index=None, meta='{"document": {"base_urn": "urn:cts:x:a.b.c", "title": "T"}, "more": [1, 2]}'):
    place = root / version
    place.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (place / name).write_text(text if text.startswith("<") else f'<chunk cts_urn="urn:cts:x:a.b.c:{name[:-4]}"><head/><elements>{text}</elements></chunk>', encoding="utf-8")
    (place / "index.json").write_text(json.dumps({"chunks": [{"file": f, "n": 1} for f in index or texts], "kept": "as it is"}))
    if meta:
        (place / "metadata.json").write_text(meta)


def test_a_tree_of_chunks_is_taken_in_and_given_out(spark, tmp_path):
    from lexforge.plans.cli import main

    root, out, base = tmp_path / "proto", tmp_path / "tokens", str(tmp_path / "base")
    chunk_tree(root, "x/a/b/c", {"2.xml": "two words", "1.xml": "one", "bad.xml": "<chunk", "extra.xml": "unlisted"}, ["2.xml", "1.xml", "bad.xml", "lost.xml"])
    chunk_tree(root, "x/d [e]", {"1.xml": "other"}, meta=None)
    store = pipeline.Store(spark, base)
    assert main(["tokenize", "--base", base, "--plain-lang", "la", "--proto-dir", str(root), "--tokens-dir", str(out)], spark) == 0
    rows = {(r["version_path"], r["chunk_name"]): (r["ord"], r["urn"], r["primary_text"]) for r in store.read("chunks", pipeline.CHUNKS).collect()}
    assert rows == {("x/a/b/c", "2.xml"): (0, "urn:cts:x:a.b.c:2", "two words"), ("x/a/b/c", "1.xml"): (1, "urn:cts:x:a.b.c:1", "one"), ("x/d [e]", "1.xml"): (0, "urn:cts:x:a.b.c:1", "other")}
    for name in ("index.json", "metadata.json"):
        assert (out / "x/a/b/c" / name).read_bytes() == (root / "x/a/b/c" / name).read_bytes()
    assert sorted(p.name for p in (out / "x/a/b/c").glob("*.zst")) == ["1.tokens.json.zst", "2.tokens.json.zst"] and not list(out.glob(".draft*"))
    assert pipeline.import_tree(spark, str(root), store) == {"versions": 0, "read": 0, "broken": 0}
    assert pipeline.tokenize(spark, store, greek, VERSIONS)["generated"] == 3  # other versions than the command's
    # an edit reads one file; the chunk that was broken is tried again with its version
    time.sleep(1.1)
    chunk_tree(root, "x/a/b/c", {"1.xml": "one more"}, ["1.xml", "2.xml", "bad.xml"])
    assert pipeline.import_tree(spark, str(root), store) == {"versions": 1, "read": 1, "broken": 1}
    rows = {r["chunk_name"]: (r["ord"], r["primary_text"]) for r in store.read("chunks", pipeline.CHUNKS).filter("version_path = 'x/a/b/c'").collect()}
    assert rows == {"1.xml": (0, "one more"), "2.xml": (1, "two words")}
    counts = pipeline.tokenize(spark, store, greek, VERSIONS)
    assert (counts["generated"], counts["skipped"]) == (1, 2)
    # a version whose index is gone goes, and pruning drops its sidecars
    (root / "x/d [e]/index.json").unlink()
    pipeline.import_tree(spark, str(root), store)
    assert {r["version_path"] for r in store.read("chunks", pipeline.CHUNKS).collect()} == {"x/a/b/c"}
    assert pipeline.prune_stale(store) == 1


def test_a_failed_export_leaves_the_old_tree_whole(spark, tmp_path):
    from lexforge.sources.sidecars import export_tree

    rows = lambda text, bad: spark.range(40).select(F.concat(F.lit("v/"), (F.col("id") % 4).cast("string")).alias("version_path"), F.concat(F.col("id").cast("string"), F.lit(".zst")).alias("sidecar"), F.when(F.col("id") == bad, F.raise_error(F.lit("gone")).cast("binary")).otherwise(F.lit(text).cast("binary")).alias("payload"))
    assert export_tree(rows("old", -1), str(tmp_path / "t")) == 40
    with pytest.raises(Exception, match="gone"):
        export_tree(rows("new", 33), str(tmp_path / "t"))
    files = [p for p in (tmp_path / "t").rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert len(files) == 40 and {p.read_text() for p in files} == {"old"} and not list((tmp_path / "t").glob(".draft*"))


def test_registry_and_statistics(spark, corpus, tmp_path):
    from lexforge.plans.cli import main

    (tmp_path / "corpora.json").write_text(json.dumps([{"name": "greek", "tag_name": "1", "repo_owner": "o", "repo_name": "r", "branch": "b"}]))
    base = str(tmp_path / "base")
    main(["pipeline", "--corpus-root", str(corpus), "--base", base, "--plain-lang", "grc", "--registry", str(tmp_path / "corpora.json"), "--corpus", "greek"], spark)
    assert pipeline.Store(spark, base).read("works", pipeline.WORKS).head()["source_repo"] == "o/r"
    assert main(["index", "--base", base, "--out", str(tmp_path / "out"), "--analyze", "stat_"], spark) == 0
    try:
        assert spark.table("stat_documents").count() == 1 and "rows" in spark.sql("DESCRIBE EXTENDED stat_forms").filter("col_name = 'Statistics'").head()["data_type"]
    finally:
        for t in spark.catalog.listTables():
            if t.name.startswith("stat_"):
                spark.sql(f"DROP TABLE {t.name}")


def test_a_stream_of_changes_makes_only_what_changed(spark, tmp_path):
    """New chunks, an edit that comes twice, a removal, a new version of the pipeline, and a batch that comes again."""
    from lexforge.streaming.ingest import CHANGES, ingest_changes, take_changes

    store, counts = pipeline.Store(spark, str(tmp_path / "store")), []

    def send(rows, versions=VERSIONS):
        if rows:
            spark.createDataFrame(rows, CHANGES).write.mode("append").parquet(str(tmp_path / "in"))
        ingest_changes(spark, str(tmp_path / "in"), store, greek, versions, str(tmp_path / "ck"), counts).awaitTermination()
        return {(r["chunk_name"], r["primary_text"]) for r in store.read("chunks", pipeline.CHUNKS).collect()}

    row = lambda v, n, text, at, gone=None: (v, f"{n}.xml", n, f"urn:cts:a:{v}:{n}", text, gone, at)
    first = [row("v", 1, "a b", 1), row("v", 2, "c", 2), row("w", 1, None, 3)]
    assert send(first) == {("1.xml", "a b"), ("2.xml", "c"), ("1.xml", None)} and counts[-1]["generated"] == 3
    assert send([row("v", 2, "later", 9), row("v", 2, "sooner", 8)]) == {("1.xml", "a b"), ("2.xml", "later"), ("1.xml", None)}
    assert (counts[-1]["generated"], counts[-1]["skipped"]) == (1, 2)
    assert send([row("w", 1, None, 10, True)]) == {("1.xml", "a b"), ("2.xml", "later")} and counts[-1]["pruned"] == 1
    take_changes(spark, store, spark.createDataFrame([row("v", 2, "later", 9)], CHANGES))
    assert pipeline.tokenize(spark, store, greek, VERSIONS)["skipped"] == 2
    assert send([row("v", 3, "new", 11)], VERSIONS | {"spacy": "5"}) and counts[-1]["generated"] == 3
    assert {r["chunk_name"]: [t["text"] for t in r["tokens"]] for r in store.read("sidecars", pipeline.SIDECARS).collect()} == {"1.xml": ["a", "b"], "2.xml": ["later"], "3.xml": ["new"]}
