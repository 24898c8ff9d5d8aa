"""Running a function over (id, whole text) rows in Arrow batches of bounded size."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a function gets at once, and bytes of the batches that they are cut from.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows, whatever the session's batch size.

    The bytes of a batch can only be bound in the session; that bound is lowered to BATCH_BYTES once, for all operators
    alike, and a lower one stays.  One row may exceed it.
    """
    conf = df.sparkSession.conf
    if int(re.sub(r"\D", "", conf.get(_LIMIT))) > BATCH_BYTES:
        conf.set(_LIMIT, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(b.slice(a, rows) for b in batches for a in range(0, b.num_rows, rows))
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system: workers wait for their next task with what they hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, id_col: str = "doc_id", text_col: str = "text", more: tuple = ()) -> DataFrame:
    """``fn`` gets batches of (doc_id, text) and the columns ``more``; other columns are not read, so their names don't matter."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    return map_batches(rows, fn, schema)


def strings(column: pa.Array) -> list[str]:
    """Values of a string column; nulls are empty."""
    return [x or "" for x in column.to_pylist()]
