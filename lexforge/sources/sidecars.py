"""Token sidecars and chunk trees on disk, in the layout that other tools read: root/namespace/textgroup/work/version/."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions.names import sidecar_name
from lexforge.schema import CHUNK_INDEX, METADATA, SIDECAR, SIDECAR_SUFFIX
from lexforge.sources.storage import forget, kept, remove
from lexforge.sources.trees import bound_batches, dealt, file_system, files_at, opened, reached, sliced

_VERSION = r"/([^/]+/[^/]+/[^/]+/[^/]+)/[^/]+$"
#: What stands beside the sidecars of a version.
BESIDE = ("index.json", "metadata.json")


def _files(spark: SparkSession, root: str) -> DataFrame:
    """Rows (version_path, name, content) of a tree's files as Spark's reader lists them; none if nothing is there."""
    pattern = f"{root.rstrip('/')}/*/*/*/*/{{*{SIDECAR_SUFFIX},{','.join(BESIDE)}}}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(pattern)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place):
        return spark.createDataFrame([], "version_path string, name string, content binary")
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(F.regexp_extract("path", _VERSION, 1).alias("version_path"), F.substring_index("path", "/", -1).alias("name"), "content")


def list_tree(spark: SparkSession, root: str, beside: bool = False) -> DataFrame:
    """Rows (version_path, name) of the sidecars four levels under a root, and no deeper; with ``beside`` of their indexes and metadata too."""
    others = BESIDE if beside else ()
    if top := reached(spark, root):
        found = files_at(spark, top, 4, lambda name: name in others or name.endswith(SIDECAR_SUFFIX) and not name.startswith("."))
        return found.withColumnRenamed("folder", "version_path")
    name = F.col("name")
    return _files(spark, root).select("version_path", "name").filter(name.isin(*others) | name.endswith(SIDECAR_SUFFIX) & ~name.startswith("."))


def open_tree(spark: SparkSession, root: str, files: DataFrame, made: Callable[[bytes], tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """``files`` of a tree (version_path, name, ...) with what ``made`` makes of their bytes."""
    top = reached(spark, root)
    if not top:
        files = files.join(_files(spark, root), ["version_path", "name"])
    return opened(dealt(files).withColumnRenamed("version_path", "folder"), top, made, columns).withColumnRenamed("folder", "version_path")


def parse_index(content: str = "content"):
    """array<struct<file>> of an index.json; null for a broken one."""
    return F.from_json(F.col(content).cast("string"), CHUNK_INDEX, {"mode": "PERMISSIVE"})["chunks"]


def parse_metadata(content: str = "content"):
    return F.from_json(F.col(content).cast("string"), METADATA, {"mode": "PERMISSIVE"})["document"]


def listed_names(index: DataFrame) -> DataFrame:
    """Rows (version_path, ord, chunk_name) of the chunks that index files list."""
    return index.select("version_path", F.posexplode("chunks").alias("ord", "c")).select("version_path", "ord", F.col("c.file").alias("chunk_name"))


def chunk_listing(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Of the listed chunks (version_path, ord, chunk_name) those that exist."""
    return listed.join(files.select("version_path", "chunk_name").distinct(), ["version_path", "chunk_name"], "left_semi").select("version_path", "ord", "chunk_name")


def read_versions(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Distinct (root, version_path) with a sidecar directly in them: four levels under a root, and no deeper."""
    return read_sidecar_names(spark, roots).select("root", "version_path").distinct()


def read_sidecar_names(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Rows (root, version_path, sidecar) of all roots; a root's number is its place in the list."""
    out = None
    for k, root in enumerate(roots):
        rows = list_tree(spark, root).select(F.lit(k).alias("root"), "version_path", F.col("name").alias("sidecar"))
        out = rows if out is None else out.unionByName(rows)
    return out


def read_sidecars(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Rows for ``build_index``: root, version_path, chunk_name, urn, lang, tokens, error, meta_base_urn, title, author, source_repo, ord.

    A sidecar that can't be unpacked or is no JSON object has an ``error`` and no tokens.  ``ord`` is the place in the version's index.json, null if that does not list the chunk.
    A tree is listed once, and what its indexes and metadata say joins the names, before sidecars are opened: these don't move.
    """
    out = None
    schema = f"struct<{SIDECAR.replace('urn string, lang string, tokens ', 'urn:string,lang:string,tokens:')}>"
    for k, root in enumerate(roots):
        names = kept(list_tree(spark, root, beside=True), "names")
        index, meta = (open_tree(spark, root, names.filter(F.col("name") == name), lambda data: (data,), {"content": pa.binary()}) for name in BESIDE)
        listed = listed_names(index.select("version_path", parse_index().alias("chunks")))
        listed = listed.select("version_path", "ord", sidecar_name(F.col("chunk_name")).alias("name")).groupBy("version_path", "name").agg(F.min("ord").alias("ord"))
        meta = meta.select("version_path", parse_metadata().alias("m")).select("version_path", F.col("m.base_urn").alias("meta_base_urn"), "m.title", "m.author", "m.source_repo")
        # packed names are small for their number, so that Spark would send them all through the driver
        found = names.filter(~F.col("name").isin(*BESIDE)).join(listed.hint("merge"), ["version_path", "name"], "left").join(meta.hint("merge"), "version_path", "left")
        rows = open_tree(spark, root, found, _unpack, {"json": pa.string(), "error": pa.string()}).withColumn("s", F.from_json("json", schema))
        rows = rows.select("version_path", F.col("name").alias("chunk_name"), F.lit(k).alias("root"), "s.urn", "s.lang", F.coalesce("s.tokens", F.array()).alias("tokens"), "error", "ord", "meta_base_urn", "title", "author", "source_repo")
        out = rows if out is None else out.unionByName(rows)
    return out


def _unpack(data: bytes) -> tuple[str | None, str | None]:
    """A sidecar's JSON, or what is wrong with it."""
    try:
        text = zstandard.ZstdDecompressor().decompressobj().decompress(data).decode()
        if not isinstance(json.loads(text), dict):
            raise ValueError("no object")
    except (zstandard.ZstdError, ValueError) as e:
        return None, f"{type(e).__name__}: {e}"
    return text, None


def pack_sidecars(rows: DataFrame, level: int = 19) -> DataFrame:
    """Rows (version_path, sidecar, payload): each sidecar as zstandard-compressed JSON."""
    ready = rows.select("version_path", sidecar_name(F.col("chunk_name")).alias("sidecar"), F.to_json(F.struct("urn", "lang", "tokens"), {"ignoreNullFields": "false"}).alias("json"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=level)
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.compress(x.encode()) for x in b.column(2).to_pylist()], pa.binary())], names=["version_path", "sidecar", "payload"])

    return ready.mapInArrow(run, "version_path string, sidecar string, payload binary")


def _draft(version: str, name: str) -> str:
    """Where a file is written first: in one of 256 folders, so that few are left to delete when all are moved."""
    digest = hashlib.sha256(f"{version}/{name}".encode()).hexdigest()
    return f"{digest[:2]}/{digest}"


def export_tree(rows: DataFrame, root: str) -> int:
    """Writes (version_path, sidecar, payload) as files under a folder that all executors share; returns their number.

    Tasks write all files into a folder beside the tree first, and move them to their places only when every one is
    there: where a task fails, the old tree stays whole and what was written goes.  A task that runs again replaces what
    it left, and passes over what it has moved.
    """
    bound_batches(rows.sparkSession)
    top = root.rstrip("/")
    beside = f".draft-{uuid.uuid4().hex}"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(top)
        for b in sliced(batches):
            drafts = [_draft(*x) for x in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True)]
            for folder in {d[:2] for d in drafts}:
                fs.create_dir(f"{base}/{beside}/{folder}", recursive=True)
            for draft, payload in zip(drafts, b.column(2).to_pylist(), strict=True):
                with fs.open_output_stream(f"{base}/{beside}/{draft}", compression=None) as out:
                    out.write(payload)
            yield b.select([0, 1])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(top)
        for b in sliced(batches):
            for version in set(b.column(0).to_pylist()):
                fs.create_dir(f"{base}/{version}", recursive=True)
            for version, name in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True):
                draft, place = f"{base}/{beside}/{_draft(version, name)}", f"{base}/{version}/{name}"
                if fs.get_file_info(draft).type != pa_fs.FileType.NotFound:
                    fs.move(draft, place)
                elif fs.get_file_info(place).type == pa_fs.FileType.NotFound:
                    raise FileNotFoundError(place)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    try:
        written = kept(rows.select("version_path", "sidecar", "payload").mapInArrow(put, "version_path string, sidecar string"), "written")
        n = written.mapInArrow(move, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
        forget(written)
        return n
    finally:
        remove(rows.sparkSession, f"{top}/{beside}")


def read_corpora(spark: SparkSession, path: str) -> DataFrame:
    """The corpus registry: name, tag_name, repo_owner, repo_name, branch."""
    from lexforge.schema import CORPUS

    return spark.read.schema(CORPUS).json(path, multiLine=True)


def version_files(works: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows (version_path, sidecar, payload): the index.json and metadata.json that go beside sidecars."""
    files = F.transform(F.array_sort(F.collect_list(F.struct("ord", "chunk_name"))), lambda c: F.struct(c["chunk_name"].alias("file")))
    index = chunks.groupBy("version_path").agg(files.alias("chunks")).select("version_path", F.lit("index.json").alias("sidecar"), F.to_json(F.struct("chunks")).alias("json"))
    document = F.struct("base_urn", "title", "author", "source_repo")
    meta = works.select("version_path", F.lit("metadata.json").alias("sidecar"), F.to_json(F.struct(document.alias("document"))).alias("json"))
    return index.unionByName(meta).select("version_path", "sidecar", F.col("json").cast("binary").alias("payload"))
