"""Streams of chunks: additive ingest with the native tokenizer, and changes that update a store.

``ingest`` tokenizes rows as they arrive and keeps no state.  ``ingest_changes`` takes edits and removals too: a store's
leveled tables are the state, so that a batch makes only what it changed, and one that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexforge.functions.keys import fold_text
from lexforge.functions.names import urn_base
from lexforge.plans.pipeline import CHUNKS, WORKS, Store, tokenize
from lexforge.plans.tokenize import Analyzer, tokenize_native
from lexforge.sources.storage import forget, kept


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Tokenizes all chunk files (version_path, chunk_name, urn, primary_text) that have not been seen, and stops.

    Every micro-batch is written to a folder of its own under ``target``, so that a batch that is run again replaces
    what it left.
    """

    def put(batch: DataFrame, number: int) -> None:
        tokenize_native(batch, ["version_path", "chunk_name"]).write.mode("overwrite").parquet(f"{target}/batch={number}")

    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


CHANGES = "version_path string, chunk_name string, ord int, urn string, primary_text string, deleted boolean, at bigint"


def take_changes(spark: SparkSession, store: Store, changes: DataFrame) -> None:
    """Brings rows (CHANGES) into a store's chunks: of a chunk's rows the one with the highest ``at`` counts, and ``deleted`` removes it.

    A version that a change touches is written anew with its other chunks as they were; one that loses all chunks goes.
    """
    key = ["version_path", "chunk_name"]
    last = kept(changes.groupBy(*key).agg(F.max_by(F.struct("ord", "urn", "primary_text", F.coalesce("deleted", F.lit(False)).alias("deleted")), "at").alias("c")).select(*key, "c.*"), "changes")
    chunks = store.read("chunks", CHUNKS)
    versions = last.select("version_path").distinct()
    others = chunks.join(versions, "version_path", "left_semi").join(last.select(*key), key, "left_anti")
    new = last.filter("not deleted").withColumn("sha", F.sha2(F.coalesce("primary_text", F.lit("")), 256)).select(*others.columns)
    whole = kept(others.unionByName(new), "changed-versions")
    known = store.read("works", WORKS).select("version_path")
    works = new.groupBy("version_path").agg(urn_base(F.min_by("urn", "ord")).alias("base_urn")).join(known, "version_path", "left_anti")
    works = works.select("version_path", "base_urn", *[F.lit(None).cast("string").alias(c) for c in ("title", "author", "source_repo")], F.current_timestamp().alias("compiled_at"))
    emptied = kept(versions.join(whole.select("version_path").distinct(), "version_path", "left_anti"), "emptied")
    if not whole.isEmpty():
        store.append("chunks", whole)
    if not works.isEmpty():
        store.append("works", works)
    if not emptied.isEmpty():
        for table, schema in (("chunks", CHUNKS), ("works", WORKS)):
            store.write(table, store.read(table, schema).join(emptied, "version_path", "left_anti"))
    forget(last, whole, emptied)


def ingest_changes(spark: SparkSession, source: str, store: Store, model: Callable[[], Analyzer], versions: dict[str, str], checkpoint: str, counts: list[dict] | None = None) -> StreamingQuery:
    """Takes all files of changes that have not been seen into ``store``, makes what is out of date, prunes what is gone, and stops."""

    def put(batch: DataFrame, number: int) -> None:
        take_changes(spark, store, batch)
        done = tokenize(spark, store, model, versions, prune=True)
        if counts is not None:
            counts.append(done)

    rows = spark.readStream.schema(CHANGES).parquet(source)
    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def register_functions(spark: SparkSession) -> None:
    """``match_key`` and ``loose_key`` as SQL functions (JVM expressions have no names of their own, so these are Arrow UDFs)."""

    def make(loose: bool):
        @F.pandas_udf("string")
        def run(text: pd.Series, lang: pd.Series) -> pd.Series:
            return pd.Series([None if t is None else fold_text(t, lg or "", loose) for t, lg in zip(text, lang, strict=True)])

        return run

    spark.udf.register("match_key", make(False))
    spark.udf.register("loose_key", make(True))
