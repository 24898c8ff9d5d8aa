"""Trees of many files: the driver holds none of their names, whichever store they are in."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexforge.sources import trees
from lexforge.sources.sidecars import export_tree, list_tree, pack_sidecars, read_sidecar_names, read_sidecars, read_versions, version_files

VERSIONS, CHUNKS = 7, 5


def put_tree(spark, root):
    ids = spark.range(VERSIONS * CHUNKS).select((F.col("id") % VERSIONS).cast("string").alias("v"), F.floor(F.col("id") / VERSIONS).cast("int").alias("ord"))
    chunks = ids.select(F.concat(F.lit("n/g"), "v", F.lit("/w/v1")).alias("version_path"), "ord", F.concat(F.col("ord").cast("string"), F.lit(".xml")).alias("chunk_name"), F.concat(F.lit("u:"), "v", F.lit(":"), F.col("ord").cast("string")).alias("urn"), F.lit("la").alias("lang"), F.array().cast("array<struct<text:string>>").alias("tokens"))
    works = chunks.select("version_path", F.lit("b").alias("base_urn"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("author"), F.lit("r").alias("source_repo")).distinct()
    deeper = pack_sidecars(chunks.filter("ord = 0")).withColumn("version_path", F.concat("version_path", F.lit("/line")))
    assert export_tree(pack_sidecars(chunks).unionByName(deeper).unionByName(version_files(works, chunks)), str(root)) == VERSIONS * (CHUNKS + 1 + 2)
    return str(root)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return put_tree(spark, tmp_path_factory.mktemp("a tree"))


def _rows(df):
    return sorted((r["version_path"], r["chunk_name"], r["urn"], r["ord"], r["meta_base_urn"], r["title"], r["error"]) for r in df.collect())


WANT = sorted((f"n/g{v}/w/v1", f"{k}.tokens.json.zst", f"u:{v}:{k}", k, "b", "t", None) for v in range(VERSIONS) for k in range(CHUNKS))


def test_the_driver_holds_no_names(spark, root):
    found = [read_sidecars(spark, [root]), read_sidecar_names(spark, [root]), read_versions(spark, [root])]
    assert not [f for df in found for f in df.inputFiles() if "/n/g" in f]
    assert _rows(found[0]) == WANT and "Broadcast" not in found[0]._jdf.queryExecution().executedPlan().toString()
    assert [df.count() for df in found[1:]] == [VERSIONS * CHUNKS, VERSIONS]


def test_a_root_is_no_pattern(spark, root, tmp_path):
    (tmp_path / "tree [1]").symlink_to(root)
    assert read_versions(spark, [str(tmp_path / "tree [1]")]).count() == VERSIONS


def test_files_are_dealt_out(spark, root):
    """However few bytes their names are, and though a join has dealt these by the same keys."""
    assert read_sidecars(spark, [root]).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_drafts_are_few_folders(spark, tmp_path, monkeypatch):
    from lexforge.sources import sidecars

    left = []
    monkeypatch.setattr(sidecars, "remove", lambda spark, path: left.extend(p for p in tmp_path.glob(".draft*/**/*") if not p.name.startswith(".")))
    put_tree(spark, tmp_path)
    assert 0 < len(left) <= 256 and all(p.is_dir() and len(p.relative_to(tmp_path).parts) == 2 for p in left)


def test_files_to_write_come_in_small_batches(spark, tmp_path):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    for before, after in (("64m", str(trees.BATCH)), ("1000", "1000")):
        spark.conf.set(limit, before)
        export_tree(spark.createDataFrame([("a/b/c/d", "x", bytearray(b"1"))], "version_path string, sidecar string, payload binary"), str(tmp_path))
        assert spark.conf.get(limit) == after
    spark.conf.set(limit, str(trees.BATCH))


def test_stores_that_only_spark_reads(spark, root):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.trees.link./in", "file:" + root.rsplit("/", 1)[0])
    other = f"viewfs://trees/in/{root.rsplit('/', 1)[1]}"
    assert trees.reached(spark, root) == root and trees.reached(spark, other) is None
    assert _rows(read_sidecars(spark, [other])) == WANT
    assert sorted(map(tuple, list_tree(spark, other, beside=True).collect())) == sorted(map(tuple, list_tree(spark, root, beside=True).collect()))
    assert read_versions(spark, [root, other]).count() == 2 * VERSIONS


def test_no_folder_has_no_sidecars(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    for place in (tmp_path / "gone", tmp_path / "file", tmp_path):
        assert read_sidecars(spark, [str(place)]).count() == read_sidecar_names(spark, [str(place)]).count() == 0


def test_python_holds_few_opened_files(spark, tmp_path, monkeypatch):
    """A batch ends where its files are large; every file is there, and passes on what came with it."""
    (tmp_path / "d").mkdir()
    for k in range(20):
        (tmp_path / "d" / str(k)).write_bytes(b"x" * 10 * k)
    ask = spark.range(20).coalesce(1).select(F.lit("d").alias("folder"), F.col("id").cast("string").alias("name"), "id")
    kept = {}
    monkeypatch.setattr(type(ask), "mapInArrow", lambda self, run, schema: kept.update(run=run, schema=schema))
    monkeypatch.setattr(trees, "HELD", 300)
    trees.opened(ask, str(tmp_path), lambda data: (data, str(len(data))), {"content": pa.binary(), "n": pa.string()})
    batch = pa.record_batch({"folder": ["d"] * 20, "name": [str(k) for k in range(20)], "id": list(range(20))})
    parts = list(kept["run"](iter([batch])))
    assert len(parts) > 5 and max(sum(len(x) for x in p.column("content").to_pylist()) for p in parts) < 300 + 190
    assert [(r["name"], r["id"], r["n"]) for p in parts for r in p.to_pylist()] == [(str(k), k, str(10 * k)) for k in range(20)]
