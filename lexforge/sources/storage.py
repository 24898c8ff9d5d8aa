"""Places that all executors share, and small files on any store that Spark reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; in a temporary one only where none is set (local tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lexforge-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """A folder's whole name, as Spark's file columns begin with it."""
    place, fs = _fs(spark, path)
    return fs.makeQualified(place).toString().rstrip("/")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside its place and then renames it over the old one, in one step where the store can."""
    place, fs = _fs(spark, path)
    fs_classes = spark.sparkContext._jvm.org.apache.hadoop.fs
    beside = fs_classes.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename_kind = getattr(fs_classes, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename_kind, 1)
    how[0] = rename_kind.OVERWRITE
    context = fs_classes.FileContext.getFileContext(fs.makeQualified(place).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(beside), fs.makeQualified(place), how)


def put_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that must not exist yet, in one step."""
    place, fs = _fs(spark, path)
    if fs.exists(place):
        raise FileExistsError(path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(beside, place):
        raise FileExistsError(path)


def names_in(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder; None if it does not exist."""
    place, fs = _fs(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(place)] if fs.exists(place) else None


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    place, fs = _fs(spark, path)
    return int(fs.getContentSummary(place).getLength())


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if it does not exist."""
    place, fs = _fs(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder; False if it was not there."""
    place, fs = _fs(spark, path)
    return bool(fs.delete(place, True))


def rename(spark: SparkSession, old: str, new: str) -> None:
    (a, fs), (b, _) = _fs(spark, old), _fs(spark, new)
    if not fs.rename(a, b):
        raise OSError(f"{new} could not be written")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer splits than the cluster has cores, dealt out over these; any larger one as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet (zstd) to a shared place and read back: made once, with a short plan, safe from lost executors.

    ``forget`` deletes it; what is not forgotten stays until that place is cleared.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes what ``kept`` wrote; nothing may read these tables any more."""
    for df in tables:
        remove(df.sparkSession, df._kept_at)
