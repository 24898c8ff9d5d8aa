"""Array expressions whose cost stays near linear in the length of the array."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is made once; an expression inside of a lambda would be made for every element."""
    return F.get(F.transform(F.array(value), body), 0)


@F.arrow_udf(T.ArrayType(T.LongType()))
def running_sums(values: pa.Array) -> pa.Array:
    """The sums of all prefixes of arrays of whole numbers without nulls."""
    lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    sums = np.concatenate([[0], np.cumsum(values.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(sums[1:] - np.repeat(sums[offsets[:-1]], lengths), pa.int64()))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """All prefixes of an array of whole numbers joined by an associative ``join``, in as many steps as the length has bits."""
    steps = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(values)))), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.aggregate(steps, values, lambda acc, step: F.transform(acc, lambda v, i: F.when(i < step, v).otherwise(join(v, F.get(acc, i - step)))))
