"""Sharding by a Feistel permutation of global row numbers, in DataFrame operations only.

Rows are numbered without gaps by the order of a hash; the number, permuted, gives shard (modulo) and slot (quotient), so
that the place of any row number, and the row number at any place, can be computed alone.  The permutation works on pairs
(l, r) of digits in mixed bases a and b with a * b >= n; numbers beyond n walk on along their cycle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.staging import staged

#: Rows are numbered within buckets of a hash, of about this many rows; buckets are added up in blocks of this many.
BUCKET_ROWS, BLOCK = 1 << 18, 1 << 10
#: Copies of one row that are numbered in one task.
RUN = 1 << 16
ROUNDS, MAX_WALK = 6, 200


def feistel(x: Column, n: int, seed: int) -> Column:
    """One application of the permutation of 0..a*b-1."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))
    pair = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))

    def turn(p: Column, k: Column) -> Column:
        left = F.pmod(p["l"] + F.pmod(F.xxhash64(p["r"], k, F.lit(seed)), F.lit(a)), F.lit(a))
        return F.struct(left.alias("l"), F.pmod(p["r"] + F.pmod(F.xxhash64(left, k, F.lit(seed + 1)), F.lit(b)), F.lit(b)).alias("r"))

    return F.aggregate(F.array(*[F.lit(k) for k in range(ROUNDS)]), pair, turn, lambda p: p["l"] * F.lit(b) + p["r"])


def permuted(x: Column, n: int, seed: int) -> Column:
    """The place of row number ``x`` among ``n``: a bijection of 0..n-1.

    a * b exceeds n by less than the root of n, so that walks are short; one of more than MAX_WALK steps, which no
    permutation of this kind is expected to have in practice, raises an error rather than give a wrong place.
    """
    walked = lambda y: F.aggregate(F.sequence(F.lit(1), F.lit(MAX_WALK)), y, lambda z, _: F.when(z < n, z).otherwise(feistel(z, n, seed)))
    ended = lambda y: F.when(y < n, y).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))
    bound = lambda value, body: F.get(F.transform(F.array(value), body), 0)  # noqa: E731  (the value is made once)
    return bound(feistel(x, n, seed), lambda y: F.when(y < n, y).otherwise(bound(walked(y), ended)))


def bucket_bases(counts: DataFrame) -> DataFrame:
    """(bucket, base): the rows in buckets before each, from (bucket, n).

    Sums of BLOCK buckets are all that reaches the driver (400 at 10^11 rows); within a block a window adds up.
    """
    blocks = counts.withColumn("block", F.floor(F.col("bucket") / BLOCK).cast("int"))
    sums = {r["block"]: r["n"] for r in blocks.groupBy("block").agg(F.sum("n").alias("n")).collect()}
    before = [0]
    for block in range(max(sums, default=0)):
        before.append(before[-1] + sums.get(block, 0))
    upto = F.sum("n").over(Window.partitionBy("block").orderBy("bucket"))
    return blocks.select("bucket", (F.get(F.array(*[F.lit(x).cast("long") for x in before]), F.col("block")) + upto - F.col("n")).alias("base"))


def shard_rows(df: DataFrame, shards: int, seed: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number) for each row of ``df``.

    The law is ``rows``: shard counts differ by one at most.  Size is the UTF-8 bytes of the text (null: none) plus 1.
    Equal rows are interchangeable, and each gets a place of its own; null ids are ids as others; an empty table gives an
    empty one.  Other columns are not read.  The numbering depends on the rows alone, not on their partitions.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    same = staged(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")), "rows")
    n = same.agg(F.sum("copies")).head()[0] or 0
    buckets = max(1, 16 * tasks if n < 16 * tasks * BUCKET_ROWS else math.ceil(n / BUCKET_ROWS))
    same = same.withColumn("at", F.xxhash64("doc_id", "size", "text_crc32")).withColumn("bucket", F.pmod("at", F.lit(buckets)).cast("int"))
    bases = bucket_bases(same.groupBy("bucket").agg(F.sum("copies").alias("n")))
    order = Window.partitionBy("bucket").orderBy("at", "doc_id", "size", "text_crc32")
    numbered = same.join(bases, "bucket").withColumn("upto", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    own = ["doc_id", "size", "text_crc32"]
    start = F.col("base") + F.col("upto") - F.col("copies")
    # a row that is repeated very often is cut into runs, which spread over the tasks
    runs = numbered.select(*own, (F.col("base") + F.col("upto")).alias("end"), F.explode(F.sequence(start, F.col("base") + F.col("upto") - 1, F.lit(RUN).cast("long"))).alias("run"))
    runs = runs.select(*own, "run", F.least(F.col("run") + RUN, F.col("end")).alias("end")).repartition(tasks, "run")
    each = runs.select(*own, F.explode(F.sequence("run", F.col("end") - 1)).alias("row_number"))
    place = each.withColumn("place", permuted(F.col("row_number"), n, seed))
    return place.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("place", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number")
