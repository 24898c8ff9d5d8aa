from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lexforge.plans import queries as own

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in ("documents", "pages", "conversations", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(own.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = own.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = duck.execute(own.ORACLE_SQL[name])
    assert sorted(d[0] for d in got.description) == columns
    at = [[d[0] for d in got.description].index(c) for c in columns]
    want = sorted(repr(tuple(r[k] for k in at)) for r in got.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
