from __future__ import annotations

import random

from pyspark.sql import functions as F

from lexforge.operators import numbering
from lexforge.operators.numbering import dense_ids


def test_ids_are_dense_and_in_order(spark, monkeypatch):
    monkeypatch.setattr(numbering, "RANGES", 8)
    monkeypatch.setattr(numbering, "SMALL_ROWS", 20)
    rng = random.Random(1)
    rows = [(rng.choice(["a", 'b"', "ü\\", None, "x/y", "'"]), rng.randint(0, 50), float(rng.randint(0, 9))) for _ in range(700)]
    df = spark.createDataFrame(rows, "s string, n int, d double")
    order = [F.split("s", "/"), F.col("n"), F.struct(F.col("d").isNull(), F.col("d"))]
    for parts in (1, 5):
        got = dense_ids(df.repartition(parts), order, "id").collect()
        assert sorted(r["id"] for r in got) == list(range(1, 701))
        by_id = sorted(got, key=lambda r: r["id"])
        want = df.orderBy(*order).collect()
        assert [(r["s"], r["n"], r["d"]) for r in by_id] == [tuple(r) for r in want]


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(3,), (1,)], "n int")
    assert [tuple(r) for r in dense_ids(df, [F.col("n")], "id", first=0).orderBy("id").collect()] == [(1, 0), (3, 1)]
    assert dense_ids(df.limit(0), [F.col("n")], "id").collect() == []


def test_one_key_holds_most_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4500, F.lit(7)).otherwise(F.col("id")).alias("n"))
    got = sorted(r["id"] for r in dense_ids(df, [F.col("n")], "id").collect())
    assert got == list(range(1, 5001))


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(numbering, "RANGE_ROWS", 50)
    df = spark.range(20_000).select(F.xxhash64("id").alias("n"))
    got = {r["n"]: r["id"] for r in dense_ids(df, [F.col("n")], "id").collect()}
    assert got == {n: k for k, n in enumerate(sorted(got), 1)}
