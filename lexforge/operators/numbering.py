"""Dense ids in a total order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows are numbered in ranges of the order: one for each 2^20 rows, or for 256 of a table with fewer than RANGES of these.
#: Bounds come from about four times as many keys, so 10^11 rows bring some 400,000 keys to the driver.
RANGES, RANGE_ROWS, SMALL_ROWS = 64, 1 << 20, 256


def dense_ids(df: DataFrame, order: list[Column], name: str, first: int = 1) -> DataFrame:
    """``df`` with ids from ``first`` on, without gaps, in ``order``.

    Keys whose hashes fall into a share of all cut the order into ranges; each range is numbered on its own and begins
    where the counts of those before it end.  Bounds and counts are all that reaches the driver.  The ids are a function
    of the rows, not of their partitions; rows that the order leaves equal get theirs in any sequence.  ``df`` is read
    four times, so it should be a written table.
    """
    rows = df.withColumn("_key", F.struct(*[c.alias(f"k{k}") for k, c in enumerate(order)]))
    n = rows.count()
    ranges = max(min(RANGES, n // SMALL_ROWS + 1), n // RANGE_ROWS)
    step = max(1, n // (4 * max(ranges, RANGES)))
    some = rows.filter(F.pmod(F.xxhash64("_key"), F.lit(step)) == 0).select("_key").distinct().orderBy("_key")
    keys = [r[0] for r in some.select(F.to_json("_key", {"ignoreNullFields": "false"})).collect()] if ranges > 1 else []
    cuts = sorted({len(keys) * k // ranges for k in range(1, ranges)}) if keys else []
    bounds = F.from_json(F.lit("[" + ",".join(keys[c] for c in cuts) + "]"), T.ArrayType(rows.schema["_key"].dataType))
    steps = [F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)] or [F.lit(1)]
    # the number of bounds below a key, by halving
    below = F.aggregate(F.array(*steps), F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < F.col("_key"), at + step).otherwise(at))
    rows = rows.withColumn("_range", below)
    counts = {r["_range"]: r["n"] for r in rows.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    before, base = first - 1, []
    for k in range(len(cuts) + 1):
        base.append(before)
        before += counts.get(k, 0)
    offsets = F.from_json(F.lit(str(base)), T.ArrayType(T.LongType()))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return rows.withColumn(name, (F.get(offsets, F.col("_range")) + place).cast("long")).drop("_key", "_range")
