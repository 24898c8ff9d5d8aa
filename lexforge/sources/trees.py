"""Trees of very many files: tasks list and open them, and the driver holds none of their names.

Tasks reach folders that all executors share, and the stores that Arrow knows.  On any other store Spark's own reader
lists a tree, and keeps its names on the driver.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import batched

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.sources.storage import qualified

#: Rows whose texts Python holds at once.
SLICE = 512
#: Characters or bytes made of files that Python holds at once, but for those of one file.
HELD = 1 << 22
#: Names that Python holds at once.
NAMES = 8192
#: Bytes of a batch that Python gets, but for those of one row.
BATCH = 1 << 22
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def file_system(place: str) -> tuple[pa_fs.FileSystem, str]:
    return pa_fs.FileSystem.from_uri(place) if "://" in place or place.startswith("file:") else (pa_fs.LocalFileSystem(), place)


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's bound of a batch to BATCH, where whole files move; a lower one stays."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", spark.conf.get(_LIMIT).strip().lower()).groups()
    bound = int(number) << 10 * " kmgtp".index(unit or " ")
    if bound <= 0 or bound > BATCH:
        spark.conf.set(_LIMIT, str(BATCH))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices, each of which is let go before the next one is made."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


def reached(spark: SparkSession, root: str) -> str | None:
    """A folder's place as tasks reach it; None if they can't, or if it is no folder."""
    top = qualified(spark, root).removeprefix("file:")
    try:
        fs, base = file_system(top)
        return top if fs.get_file_info(base).type == pa_fs.FileType.Directory else None
    except (pa.ArrowException, OSError):
        return None


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt out over as many tasks as shuffles have, however few bytes it holds: its rows stand for files."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # by a key, it may count as done by a join before


def _names(fs: pa_fs.FileSystem, folder: str, folders: bool) -> Iterator[str]:
    """Names of the folders in a folder, or of its files."""
    if isinstance(fs, pa_fs.LocalFileSystem):
        with os.scandir(folder) as found:
            yield from (x.name for x in found if (x.is_dir() if folders else x.is_file()))
    else:
        kind = pa_fs.FileType.Directory if folders else pa_fs.FileType.File
        yield from (x.base_name for x in fs.get_file_info(pa_fs.FileSelector(folder)) if x.type == kind)


def files_at(spark: SparkSession, top: str, depth: int, wanted: Callable[[str], bool]) -> DataFrame:
    """Rows (folder, name) of the files with a wanted name in folders ``depth`` levels below a ``reached`` one; a level is one step of the tasks."""

    def within(folders: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, base = file_system(top)
            pairs = ((folder, name) for b in batches for folder in b.column(0).to_pylist() for name in _names(fs, f"{base}/{folder}".rstrip("/"), folders) if folders or wanted(name))
            for part in batched(pairs, NAMES):
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in part], pa.string()) for k in (0, 1)], names=["folder", "name"])

        return run

    level = spark.range(0, 1, 1, 1).select(F.lit("").alias("folder"))
    for _ in range(depth):
        found = level.mapInArrow(within(True), "folder string, name string")
        level = dealt(found.select(F.concat_ws("/", F.nullif(F.col("folder"), F.lit("")), "name").alias("folder")))
    return level.mapInArrow(within(False), "folder string, name string")


def opened(files: DataFrame, top: str | None, made: Callable[[bytes], tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """``files`` (folder, name, ...) with ``columns`` that ``made`` makes of each one's bytes; where ``top`` is None, ``content`` has these, and goes."""
    kinds = {c: t for c, t in files.dtypes if c != "content"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(top) if top else (None, "")

        def data(b: pa.RecordBatch, k: int) -> bytes:
            if fs is None:
                return b.column("content")[k].as_py()
            with fs.open_input_stream(f"{base}/{b.column('folder')[k].as_py()}/{b.column('name')[k].as_py()}", compression=None) as file:
                return file.read()

        for b in sliced(batches):
            at, got, held = 0, [], 0
            for k in range(b.num_rows):
                got.append(made(data(b, k)))
                held += sum(len(x) for x in got[-1] if x)
                if held >= HELD or k == b.num_rows - 1:
                    part = b.slice(at, len(got))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kinds), *(pa.array([g[i] for g in got], t) for i, t in enumerate(columns.values()))], names=[*kinds, *columns])
                    at, got, held = k + 1, [], 0

    return files.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in [*kinds.items(), *columns.items()]))
