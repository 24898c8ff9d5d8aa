from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.names import language_sample, natural_key, occurrence, path_key, pipeline_version, sidecar_name, urn_base, urn_is_valid, urn_ref, work_path


def values(spark, fn, items):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(items)], "k int, x string")
    return [r["y"] for r in df.select("k", fn(F.col("x")).alias("y")).orderBy("k").collect()]


def test_urns(spark):
    urns = ["urn:cts:g:a.b.c:1.2", "nocolon", "", None]
    assert values(spark, urn_base, urns) == ["urn:cts:g:a.b.c", "", "", None]
    assert values(spark, urn_ref, urns)[:2] == ["1.2", "nocolon"]
    assert values(spark, urn_is_valid, ["urn:cts:a:b", "urn:cts:a", "file.xml", None]) == [True, False, False, False]


def test_work_paths_drop_what_is_missing(spark):
    assert values(spark, work_path, ["urn:cts:latinLit:phi0959.phi002.alpha-lat2", "urn:cts:l:a.b", "urn:cts:l:a.b.c.d"]) == ["latinLit/phi0959/phi002/alpha-lat2", "l/a/b", "l/a/b/c"]


def test_sidecar_names(spark):
    assert values(spark, sidecar_name, ["10.xml", "1.10.xml", "a", ".x"]) == ["10.tokens.json.zst", "1.10.tokens.json.zst", "a.tokens.json.zst", ".x.tokens.json.zst"]


def test_occurrences(spark):
    assert values(spark, occurrence, ["a[2]", "a[1][13]", "a", "a[x]", "", None]) == [2, 13, 1, 1, 1, 1]


def test_orders(spark):
    refs = ["1.10", "pref.1", "1.a", "1.2", "2", "1", "²"]
    df = spark.createDataFrame([(r,) for r in refs], "r string")
    assert [x["r"] for x in df.orderBy(natural_key(F.col("r"))).collect()] == ["1", "1.2", "1.10", "1.a", "2", "pref.1", "²"]
    df = spark.createDataFrame([("a-b/x",), ("a/x",), ("a/b/c",)], "p string")
    assert [x["p"] for x in df.orderBy(path_key(F.col("p"))).collect()] == ["a/b/c", "a/x", "a-b/x"]


def test_samples(spark):
    text = "a" * 50_000 + "b" * 50_000 + "c" * 50_000
    short, long, empty = values(spark, language_sample, ["x" * 3000, text, ""])
    assert short == "x" * 3000 and empty == ""
    assert len(long) == 3002 and long[0] == "a" and "b" in long and long[-1] == "c"


def test_pipeline_versions(spark):
    v = {"spacy": "1", "stanza": "2", "la_core_web_lg": "3", "grc_dep_web_lg": "4"}
    assert values(spark, lambda c: pipeline_version(c, v), ["la", "he", "", None]) == ["2:spacy-1:la_core_web_lg-3:analyze", "2:stanza-2:tokenize", "2:empty", "2:empty"]
