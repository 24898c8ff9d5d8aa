"""Publishing an index: content-addressed folders, and a manifest that is swapped in one step."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.operators.index import CLUSTERING, Index, read_tables, write_tables
from lexforge.schema import DEFAULT_LANGS, SCHEMA_VERSION
from lexforge.sources.storage import get_text, names_in, put_text, remove, rename, shared_path, size_of


def content_digest(index: Index) -> str:
    """sha256 over the tables' digests; rows count in any order, and times don't, so equal input has an equal name."""
    import hashlib

    out = hashlib.sha256()
    for name in sorted(n for n in CLUSTERING if "_by_" not in n):
        df = index[name]
        r = df.agg(F.count("*").alias("n"), *[F.sum(F.xxhash64(F.lit(k), *sorted(df.columns)).cast("decimal(38,0)")).alias(f"h{k}") for k in (0, 1)]).head()
        out.update(f"{name}|{','.join(sorted(df.columns))}|{r['n']}|{r['h0']}|{r['h1']}\n".encode())
    return out.hexdigest()


def parse_sources(pairs: list[str]) -> dict[str, str]:
    """NAME=VALUE arguments; the first sign of equality parts them."""
    out = {}
    for p in pairs:
        name, equals, value = p.partition("=")
        if not equals:
            raise ValueError(f"{p!r} is not NAME=VALUE")
        out[name] = value
    return out


def publish(spark: SparkSession, index: Index, out: str, langs: tuple[str, ...] = DEFAULT_LANGS, sources: dict[str, str] | None = None, more: dict | None = None) -> dict:
    """Writes ``out``/search-<12 hex digits>/ and then ``out``/manifest.json; returns the manifest."""
    started = datetime.datetime.now(datetime.UTC)
    draft = f"{out.rstrip('/')}/.draft-{shared_path(spark, 'x').rsplit('-', 1)[1]}"
    write_tables(index, draft)
    stored = read_tables(spark, draft)
    digest = content_digest(stored)
    name = f"search-{digest[:12]}"
    place = f"{out.rstrip('/')}/{name}"
    if names_in(spark, place) is None:
        rename(spark, draft, place)
    else:  # equal content is published under this name, and may be in use
        remove(spark, draft)
    stats = index.stats.head().asDict()
    counts = {r["name"]: r["n"] for r in read_tables(spark, place).fences.groupBy("name").agg(F.sum("rows").alias("n")).collect()}
    counts = {t: counts.get(t, 0) for t in CLUSTERING}
    manifest = {"schema_version": SCHEMA_VERSION, "index": name, "sha256": digest, "langs": list(langs), "sources": sources or {}, **stats, **(more or {}), "tables": counts, "size": size_of(spark, place), "built_at": started.isoformat(timespec="seconds"), "seconds": round((datetime.datetime.now(datetime.UTC) - started).total_seconds())}
    put_text(spark, f"{out.rstrip('/')}/manifest.json", json.dumps(manifest, ensure_ascii=False, indent=1))
    return manifest


def open_published(spark: SparkSession, out: str) -> tuple[Index, dict]:
    """The index that the manifest names, and the manifest."""
    manifest = json.loads(get_text(spark, f"{out.rstrip('/')}/manifest.json") or "{}")
    if not manifest:
        raise FileNotFoundError(f"{out}/manifest.json")
    return read_tables(spark, f"{out.rstrip('/')}/{manifest['index']}"), manifest


def analyze_tables(spark: SparkSession, index: Index, prefix: str) -> list[str]:
    """Registers the tables under ``prefix`` in the catalogue and gathers column statistics for the optimizer."""
    names = []
    for name, df in index.tables.items():
        df.write.mode("overwrite").saveAsTable(f"{prefix}{name}")
        spark.sql(f"ANALYZE TABLE {prefix}{name} COMPUTE STATISTICS FOR ALL COLUMNS")
        names.append(f"{prefix}{name}")
    return names


def meta(spark: SparkSession, manifest: dict) -> DataFrame:
    """The index's key-value table."""
    rows = [("schema_version", str(manifest["schema_version"])), ("built_at", manifest["built_at"]), ("langs", ",".join(manifest["langs"]))]
    return spark.createDataFrame(rows, "key string, value string")
