"""Incremental state as joins of a snapshot with manifests: what is up to date, deferred, stale or failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.names import pipeline_version, sidecar_name
from lexforge.operators.numbering import dense_ids


def plan_chunks(chunks: DataFrame, manifest: DataFrame, sidecars: DataFrame, versions: dict[str, str], force: bool = False) -> DataFrame:
    """``chunks`` (version_path, chunk_name, sha) with ``up_to_date``.

    So is a chunk whose entry has the same hash and the pipeline version of the language it recorded, and whose sidecar
    exists.
    """
    key = ["version_path", "chunk_name"]
    known = manifest.select(*key, F.col("sha").alias("_sha"), F.col("lang").alias("_lang"), F.col("pipeline").alias("_pipeline"))
    there = sidecars.select("version_path", "sidecar").distinct().withColumn("_there", F.lit(True))
    rows = chunks.withColumn("sidecar", sidecar_name(F.col("chunk_name"))).join(known, key, "left").join(there, ["version_path", "sidecar"], "left")
    fresh = (F.col("_sha") == F.col("sha")) & (F.col("_pipeline") == pipeline_version(F.col("_lang"), versions)) & F.col("_there")
    return rows.withColumn("up_to_date", F.lit(False) if force else F.coalesce(fresh, F.lit(False))).drop("_sha", "_lang", "_pipeline", "_there")


def within_budget(planned: DataFrame, order: list[Column], batch: int, batches: int | None) -> DataFrame:
    """``status``: skipped where up to date; of the others the first ``batches`` batches are pending, the rest deferred.

    ``batch`` numbers the batches of what is not up to date, from 0.
    """
    todo = dense_ids(planned.filter("not up_to_date"), order, "batch", first=0).withColumn("batch", F.floor(F.col("batch") / batch).cast("long"))
    late = F.lit(False) if batches is None else F.col("batch") >= batches
    done = planned.filter("up_to_date").withColumn("batch", F.lit(None).cast("long")).withColumn("status", F.lit("skipped"))
    return todo.withColumn("status", F.when(late, "deferred").otherwise("pending")).unionByName(done)


def status_counts(rows: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    """One row with the number of rows of each status."""
    return rows.agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])


def stale_sidecars(sidecars: DataFrame, chunks: DataFrame) -> DataFrame:
    """Sidecars whose chunk is gone."""
    live = chunks.select("version_path", sidecar_name(F.col("chunk_name")).alias("sidecar"))
    return sidecars.join(live, ["version_path", "sidecar"], "left_anti")


def missing_works(manifest: DataFrame, works: DataFrame) -> DataFrame:
    """Versions with a manifest but no chunk index any more; asking twice gives the same."""
    return manifest.select("version_path").distinct().join(works.select("version_path"), "version_path", "left_anti")


def live_manifest(manifest: DataFrame, chunks: DataFrame) -> DataFrame:
    """Manifest entries of chunks that still exist."""
    return manifest.join(chunks.select("version_path", "chunk_name"), ["version_path", "chunk_name"], "left_semi")


def next_manifest(manifest: DataFrame, done: DataFrame, chunks: DataFrame) -> DataFrame:
    """The manifest after a run: new entries replace old ones, failed and deferred chunks keep theirs."""
    key = ["version_path", "chunk_name"]
    columns = [*key, "sha", "lang", "pipeline"]
    return live_manifest(manifest.join(done.select(*key), key, "left_anti").select(*columns).unionByName(done.select(*columns)), chunks)


def compile_status(sources: DataFrame, compiled: DataFrame, force: bool = False) -> DataFrame:
    """``status`` of source files: no-citestructure, failed, skipped or pending.

    Sources: path, has_structure, error, base_urn, urn_ok, modified; compiled: base_urn, compiled_at.  A work that was
    compiled no earlier than its file changed is skipped.
    """
    rows = sources.join(compiled, "base_urn", "left")
    fresh = F.lit(False) if force else F.coalesce(F.col("compiled_at") >= F.col("modified"), F.lit(False))
    status = F.when(~F.col("has_structure"), "no-citestructure").when(F.col("error").isNotNull() | ~F.col("urn_ok"), "failed").when(fresh, "skipped").otherwise("pending")
    return rows.withColumn("status", status).drop("compiled_at")


def split_failures(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows that went well, and those with an error."""
    return rows.filter(F.col(error).isNull()).drop(error), rows.filter(F.col(error).isNotNull())
