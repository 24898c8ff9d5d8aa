"""The four runs: compile sources, tokenize chunks, analyze chunks, index sidecars; and the pipeline of the first two.

State lives under a base folder as Parquet tables: ``chunks``, ``works``, ``manifest`` and ``sidecars``.  A run appends
parts, whose rows replace older ones of the same key, and publishes each by a new pointer, so that readers see a table
before or after a step, and a run that ends early loses only what it had not published.  Parts stand in levels: FANOUT
parts of one level become one of the next as soon as they are there, so that a read meets a number of parts that grows
with the logarithm of the steps, and a row is rewritten as often.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions.names import pipeline_version, sidecar_name, urn_is_valid, work_path
from lexforge.operators.incremental import compile_status, live_manifest, missing_works, plan_chunks, stale_sidecars, within_budget
from lexforge.operators.index import Index, build_index, citation_order
from lexforge.plans.publish import publish
from lexforge.plans.tokenize import Analyzer, analyze_chunks, finish
from lexforge.schema import DEFAULT_LANGS, MANIFEST, SEGMENT_CHARS, TOKEN
from lexforge.sources.sidecars import chunk_listing, export_tree, listed_names, pack_sidecars, parse_index, parse_metadata, read_sidecars, version_files
from lexforge.sources.storage import forget, get_text, kept, names_in, put_new_text, put_text, remove, shared_path
from lexforge.sources.tei import has_element, list_files, list_sources, open_files, read_chunk, split_tei

CHUNKS = "version_path string, ord int, chunk_name string, urn string, primary_text string, sha string"
WORKS = "version_path string, base_urn string, title string, author string, source_repo string, compiled_at timestamp"
FILES = "rel_path string, modified timestamp, length bigint, how string, status string, base_urn string, error string, n_chunks int"
BESIDE = "version_path string, name string, content binary"
SIDECARS = f"version_path string, chunk_name string, sha string, urn string, lang string, tokens array<{TOKEN}>"
#: What a row of a later part replaces.
KEYS = {"files": ["rel_path"], "tree_files": ["rel_path"], "beside": ["version_path", "name"], "chunks": ["version_path"], "works": ["version_path"], "manifest": ["version_path", "chunk_name"], "sidecars": ["version_path", "chunk_name"]}
#: So many parts of one level become one of the next.
FANOUT = 8
#: Batches of a run whose texts are set aside at once.
BATCHES_ASIDE = 16


@dataclass
class Store:
    """Tables under a base folder.  The pointer with the highest number names a table's parts; there is one writer."""

    spark: SparkSession
    base: str

    def _pointers(self, name: str) -> list[str]:
        found = names_in(self.spark, f"{self.base}/{name}.current")
        numbers = sorted(x for x in found or () if x.isdigit())
        if found is not None and not numbers and names_in(self.spark, f"{self.base}/{name}"):
            raise FileNotFoundError(f"{self.base}/{name}.current has lost its pointers")
        return numbers

    def parts(self, name: str) -> list[tuple[str, int]]:
        """(folder, level) of the table's parts, from old to new; levels never rise."""
        numbers = self._pointers(name)
        lines = get_text(self.spark, f"{self.base}/{name}.current/{numbers[-1]}").splitlines() if numbers else []
        return [(folder, int(level)) for folder, level in map(str.split, lines)]

    def _rows(self, name: str, schema: str, parts: list[tuple[str, int]]) -> DataFrame:
        """Rows of some neighbouring parts that no later one of these replaces, with ``_seq``, the step that wrote them.

        However many parts there are, the plan is one scan of them all and one of the later ones' keys.
        """
        places = [f"{self.base}/{name}/{folder}" for folder, _ in parts]
        rows = self.spark.read.schema(f"{schema}, _seq bigint").parquet(*places)
        if len(places) == 1:
            return rows
        key = KEYS[name]
        later = self.spark.read.schema(rows.select(*key, "_seq").schema).parquet(*places[1:])
        last = later.groupBy(*key).agg(F.max("_seq").alias("_last")).withColumnsRenamed({c: f"_{c}" for c in key})
        return rows.join(last, [F.col(c) == F.col(f"_{c}") for c in key] + [F.col("_last") > F.col("_seq")], "left_anti")

    def read(self, name: str, schema: str) -> DataFrame:
        parts = self.parts(name)
        return self._rows(name, schema, parts).drop("_seq") if parts else self.spark.createDataFrame([], schema)

    def _publish(self, name: str, df: DataFrame, parts: list[tuple[str, int]], level: int = 0) -> None:
        """Writes a part, then a pointer to ``parts`` and it, and removes what only pointers before the last one name."""
        numbers = self._pointers(name)
        number, new = int(numbers[-1]) + 1 if numbers else 0, f"v{time.time_ns()}"
        rows = df if "_seq" in df.columns else df.withColumn("_seq", F.lit(number).cast("long"))
        rows.write.option("compression", "zstd").parquet(f"{self.base}/{name}/{new}")
        before = self.parts(name)
        put_new_text(self.spark, f"{self.base}/{name}.current/{number:012d}", "\n".join(f"{folder} {at}" for folder, at in [*parts, (new, level)]))
        wanted = {folder for folder, _ in [*parts, *before]} | {new}
        for old in numbers[:-1]:
            remove(self.spark, f"{self.base}/{name}.current/{old}")
        for folder in names_in(self.spark, f"{self.base}/{name}") or ():
            if folder not in wanted:
                remove(self.spark, f"{self.base}/{name}/{folder}")

    def write(self, name: str, df: DataFrame) -> None:
        """The whole table anew; readers of the state before may go on until the next write."""
        self._publish(name, df, [])

    def append(self, name: str, df: DataFrame) -> None:
        """More rows, which replace those of the same key; full levels are merged."""
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        self._publish(name, df, self.parts(name))
        while True:
            parts = self.parts(name)
            level = parts[-1][1]
            full = parts[-FANOUT:]
            if len(full) < FANOUT or full[0][1] != level:
                return
            self._publish(name, self._rows(name, schema, full), parts[:-FANOUT], level + 1)


def _changed(listed: DataFrame, known: DataFrame, how: str, force: bool) -> DataFrame:
    """``listed`` files with ``_same``: as long and as old as when they were last read, in the same way."""
    seen = known.select("rel_path", *[F.col(c).alias(f"_{c}") for c in ("modified", "length", "how")])
    same = (F.col("_modified") == F.col("modified")) & (F.col("_length") == F.col("length")) & (F.col("_how") == how)
    rows = listed.join(seen, "rel_path", "left")
    return rows.withColumn("_same", F.lit(False) if force else F.coalesce(same, F.lit(False))).drop("_modified", "_length", "_how")


def compile_corpus(spark: SparkSession, corpus_root: str, store: Store, unit: str | None = None, force: bool = False, source_repo: str | None = None) -> DataFrame:
    """Cuts the sources of a corpus into chunks; returns (path, status, reason, urn_base, chunk_count) of every file.

    Files are listed, and only those are opened that are new, or older or longer than when they were last read; what the
    others were found to be is known.  A file without ``citeStructure`` is passed over; one whose base URN is none, or
    that does not parse, fails alone; a work compiled no earlier than its file changed is skipped.  Chunks follow the
    citation declaration, or elements ``unit`` that have an ``n`` where a name is given.
    """
    how = f"2:{unit or ''}"
    known, works = store.read("files", FILES), store.read("works", WORKS)
    listed = kept(_changed(list_sources(spark, corpus_root), known, how, force), "listed")
    files = open_files(spark, f"{corpus_root.rstrip('/')}/data", "*.xml", listed.filter("not _same").drop("_same")).withColumn("has_structure", has_element(F.col("content")))
    parsed = files.withColumn("s", F.when(F.col("has_structure"), split_tei(F.col("content"), unit)))
    rows = parsed.select("rel_path", "modified", "length", "has_structure", F.coalesce("s.base_urn", F.lit("")).alias("base_urn"), "s.title", "s.author", "s.chunks", "s.error").withColumn("urn_ok", urn_is_valid(F.col("base_urn")))
    done = works.groupBy("base_urn").agg(F.max("compiled_at").alias("compiled_at"))
    status = kept(compile_status(rows, done, force).withColumn("version_path", work_path(F.col("base_urn"))), "compiled")
    fresh = status.filter("status = 'pending'")
    reason = F.when(F.col("status") == "failed", F.coalesce("error", F.concat(F.lit("no CTS URN: "), "base_urn")))
    now = status.select("rel_path", "modified", "length", F.lit(how).alias("how"), F.when(F.col("status") == "pending", "compiled").otherwise(F.col("status")).alias("status"), "base_urn", reason.alias("error"), F.when(F.col("status") == "pending", F.size("chunks")).alias("n_chunks"))
    before = known.join(listed.filter("_same").select("rel_path"), "rel_path", "left_semi").withColumn("status", F.when(F.col("status") == "compiled", "skipped").otherwise(F.col("status"))).withColumn("n_chunks", F.lit(None).cast("int"))
    found = kept(now.unionByName(before), "found")
    if not fresh.isEmpty():
        made = fresh.select("version_path", "base_urn", F.posexplode("chunks").alias("ord", "c")).select("version_path", "ord", F.concat("c.ref", F.lit(".xml")).alias("chunk_name"), F.concat("base_urn", F.lit(":"), "c.ref").alias("urn"), F.col("c.text").alias("primary_text"))
        store.append("chunks", made.withColumn("sha", F.sha2("primary_text", 256)))
        store.append("works", fresh.select("version_path", "base_urn", "title", "author", F.lit(source_repo).cast("string").alias("source_repo"), F.current_timestamp().alias("compiled_at")))
    if not status.isEmpty():  # last, so that files of a run that ends early are read again
        store.append("files", now.withColumn("status", F.when(F.col("status") == "skipped", "compiled").otherwise(F.col("status"))))
    forget(listed)
    return found.select(F.col("rel_path").alias("path"), "status", F.col("error").alias("reason"), F.when(F.col("status").isin("compiled", "skipped"), F.col("base_urn")).alias("urn_base"), F.col("n_chunks").alias("chunk_count"))


def import_tree(spark: SparkSession, root: str, store: Store, force: bool = False) -> dict[str, int]:
    """Takes a tree of chunk files into the store; returns counts of versions, chunks that were read, and chunks that are broken.

    A version is a folder with an index.json; its chunks are those that this lists and that are there.  Files are listed,
    and only those are opened that changed; a version of which a file came, changed or went is written anew, with the rows
    of its other chunks as they were.  index.json and metadata.json are kept byte by byte.  Broken chunks stay out.
    """
    folder, name = F.regexp_extract("rel_path", "^(?:(.*)/)?[^/]+$", 1), F.substring_index("rel_path", "/", -1)
    listed = list_files(spark, root, "*.{xml,json}").withColumn("version_path", folder).withColumn("name", name)
    known = store.read("tree_files", FILES)
    files = kept(_changed(listed, known, "1", force), "tree-listed")
    index = files.filter("name = 'index.json'").select("version_path")
    gone = known.join(files.select("rel_path"), "rel_path", "left_anti").select(folder.alias("version_path"))
    touched = kept(files.filter("not _same").select("version_path").unionByName(gone).distinct().join(index, "version_path", "left_semi"), "touched")
    of_touched = files.join(touched, "version_path", "left_semi")
    # index and metadata are small, and read for every version that is written anew
    beside = kept(open_files(spark, root, "*.json", of_touched.filter("name in ('index.json', 'metadata.json')")).select("version_path", "name", "content"), "beside")
    names = listed_names(beside.filter("name = 'index.json'").select("version_path", parse_index().alias("chunks")))
    order = chunk_listing(names, of_touched.filter("name like '%.xml'").withColumnRenamed("name", "chunk_name")).groupBy("version_path", "chunk_name").agg(F.min("ord").alias("ord"))
    order = kept(order, "tree-order")
    chunk_files = of_touched.withColumnRenamed("name", "chunk_name").join(order, ["version_path", "chunk_name"])
    old = store.read("chunks", CHUNKS)
    key = ["version_path", "chunk_name"]
    same = chunk_files.filter("_same").select(*key, F.col("ord").alias("_ord")).join(old.drop("ord"), key).withColumnRenamed("_ord", "ord")
    # what could not be read before is tried again with its version
    todo = chunk_files.join(same.select(*key), key, "left_anti")
    opened = open_files(spark, root, "*.xml", todo.select("path", "version_path", "chunk_name", "ord"))
    parsed = kept(opened.select(*key, "ord", F.sha2("content", 256).alias("sha"), read_chunk(F.col("content")).alias("c")), "tree-read")
    good = parsed.filter("c.error is null").select("version_path", "ord", "chunk_name", "c.urn", "c.primary_text", "sha", "c.base_urn")
    counts = {"versions": touched.count(), "read": good.count(), "broken": parsed.filter("c.error is not null").count()}
    if counts["versions"]:
        meta = beside.filter("name = 'metadata.json'").select("version_path", parse_metadata().alias("m"))
        bases = good.groupBy("version_path").agg(F.min_by("base_urn", "ord").alias("chunk_base"))
        was = store.read("works", WORKS).select("version_path", F.col("base_urn").alias("old_base"))
        works = touched.join(meta, "version_path", "left").join(bases, "version_path", "left").join(was, "version_path", "left")
        whole = kept(good.drop("base_urn").unionByName(same.select(*good.drop("base_urn").columns)), "tree-chunks")
        store.append("beside", beside)
        store.append("chunks", whole)
        store.append("works", works.select("version_path", F.coalesce("m.base_urn", "chunk_base", "old_base").alias("base_urn"), "m.title", "m.author", "m.source_repo", F.current_timestamp().alias("compiled_at")))
        now = of_touched.select("rel_path", "modified", "length", F.lit("1").alias("how"), F.lit("read").alias("status"), *[F.lit(None).cast("string").alias(c) for c in ("base_urn", "error")], F.lit(None).cast("int").alias("n_chunks"))
        store.write("tree_files", known.join(files.select("rel_path"), "rel_path", "left_semi").join(now.select("rel_path"), "rel_path", "left_anti").unionByName(now))
        forget(whole)
    lost = store.read("works", WORKS).join(index, "version_path", "left_anti")
    if not lost.isEmpty():  # versions whose index is gone
        for table, schema in (("chunks", CHUNKS), ("works", WORKS), ("beside", BESIDE)):
            store.write(table, store.read(table, schema).join(index, "version_path", "left_semi"))
    forget(files, touched, beside, order, parsed)
    return counts


def tokenize(spark: SparkSession, store: Store, model: Callable[[], Analyzer], versions: dict[str, str], force: bool = False, prune: bool = False, deadline: float | None = None, batch: int = 1 << 16) -> dict[str, int]:
    """Makes the sidecars that are out of date; returns counts of generated, skipped, failed, deferred and pruned.

    What is up to date is found by keys and hashes alone.  Work goes in batches of ``batch`` chunks, each appended before
    the next begins; past ``deadline`` (time.monotonic), which the tasks heed too, the rest is deferred.  Failed and
    deferred chunks keep their old entry and sidecar and are tried again.
    """
    key = ["version_path", "chunk_name", "sha"]
    chunks, manifest, sidecars = store.read("chunks", CHUNKS), store.read("manifest", MANIFEST), store.read("sidecars", SIDECARS)
    have = sidecars.select("version_path", sidecar_name(F.col("chunk_name")).alias("sidecar"))
    planned = kept(plan_chunks(chunks.select(*key, "ord"), manifest, have, versions, force), "planned")
    total = {r["up_to_date"]: r["n"] for r in planned.groupBy("up_to_date").agg(F.count("*").alias("n")).collect()}
    counts = {"generated": 0, "skipped": total.get(True, 0), "failed": 0, "deferred": 0, "pruned": 0}
    left, k = total.get(False, 0), 0
    latest = None if deadline is None else time.time() + deadline - time.monotonic()
    order = [F.col("version_path"), F.col("ord"), F.col("chunk_name")]
    ranked = kept(within_budget(planned, order, batch, None).filter("status = 'pending'").groupBy(*key).agg(F.min("batch").alias("batch")), "ranked") if left else None
    aside = None
    while left > 0:
        if latest is not None and time.time() >= latest:
            counts["deferred"] = left
            break
        if k % BATCHES_ASIDE == 0:
            if aside:
                remove(spark, aside)
            aside = shared_path(spark, "pending")
            near = ranked.filter((F.col("batch") >= k) & (F.col("batch") < k + BATCHES_ASIDE))
            chunks.join(near, key).write.partitionBy("batch").parquet(aside)
        if names_in(spark, f"{aside}/batch={k}") is None:  # repeated rows of a chunk went with its first one
            k += 1
            continue
        analyzed = kept(analyze_chunks(spark.read.schema(CHUNKS).parquet(f"{aside}/batch={k}"), model, segment_chars=SEGMENT_CHARS, deadline=latest), "analyzed")
        n = analyzed.agg(F.count("*").alias("n"), F.count_if("deferred").alias("late"), F.count_if(~F.col("deferred") & F.col("error").isNotNull()).alias("bad")).head()
        done = kept(finish(analyzed), "finished")
        # sidecars first: a chunk without an entry is made again, an entry without its sidecar would not be
        store.append("sidecars", done)
        store.append("manifest", done.select("version_path", "chunk_name", "sha", "lang").withColumn("pipeline", pipeline_version(F.col("lang"), versions)))
        forget(analyzed, done)
        counts["generated"] += n["n"] - n["bad"] - n["late"]
        counts["failed"] += n["bad"]
        left, k = left - n["n"], k + 1
        if n["late"]:
            counts["deferred"] = left + n["late"]
            break
    forget(planned, *([ranked] if ranked is not None else []))
    if aside:
        remove(spark, aside)
    if counts["generated"]:
        store.write("manifest", live_manifest(store.read("manifest", MANIFEST), chunks.select(*key)))
    if prune:
        counts["pruned"] = prune_stale(store)
    return counts


def prune_stale(store: Store) -> int:
    """Drops sidecars and manifest entries of chunks and works that are gone; returns the number of sidecars."""
    chunks, sidecars, works = store.read("chunks", CHUNKS), store.read("sidecars", SIDECARS), store.read("works", WORKS)
    names = sidecars.withColumn("sidecar", sidecar_name(F.col("chunk_name")))
    gone_works = missing_works(store.read("manifest", MANIFEST), works)
    gone = stale_sidecars(names, chunks).select("version_path", "chunk_name").unionByName(names.join(gone_works, "version_path", "left_semi").select("version_path", "chunk_name")).distinct()
    gone = kept(gone, "gone")
    n = gone.count()
    if n:
        store.write("sidecars", sidecars.join(gone, ["version_path", "chunk_name"], "left_anti"))
        live = live_manifest(store.read("manifest", MANIFEST), chunks).join(gone_works, "version_path", "left_anti")
        store.write("manifest", live)
    forget(gone)
    return n


def analyze(spark: SparkSession, store: Store, model: Callable[[], Analyzer], force: bool = False) -> dict[str, int]:
    """Full analysis of chunks that have no sidecar, with whole texts; the manifest stays as it is."""
    key = ["version_path", "chunk_name"]
    chunks, sidecars = store.read("chunks", CHUNKS), store.read("sidecars", SIDECARS)
    todo = chunks if force else chunks.join(sidecars.select(*key), key, "left_anti")
    analyzed = kept(analyze_chunks(todo, model, sample=False, segment_chars=None), "analyzed")
    n = analyzed.agg(F.count("*").alias("n"), F.count("error").alias("bad")).head()
    total = chunks.count()
    store.append("sidecars", finish(analyzed))
    forget(analyzed)
    return {"generated": n["n"] - n["bad"], "failed": n["bad"], "skipped": total - n["n"]}


def sidecar_rows(stores: list[Store]) -> DataFrame:
    """Rows for ``build_index`` of several stores, in the order of the list."""
    out = None
    for k, store in enumerate(stores):
        listed = store.read("chunks", CHUNKS).select("version_path", "chunk_name", "ord")
        meta = store.read("works", WORKS).select("version_path", F.col("base_urn").alias("meta_base_urn"), "title", "author", "source_repo")
        rows = citation_order(store.read("sidecars", SIDECARS), listed, ["version_path"]).join(meta, "version_path", "left").withColumn("root", F.lit(k))
        out = rows if out is None else out.unionByName(rows)
    return out


def tree_rows(spark: SparkSession, roots: list[str]) -> tuple[DataFrame, int]:
    """Rows for ``build_index`` of sidecar trees, and the number of sidecars that can't be read; those are left out."""
    found = kept(read_sidecars(spark, roots), "sidecars")
    version = ["root", "version_path"]
    listed = found.filter("ord is not null").select(*version, "chunk_name", "ord")
    good = found.filter("error is null").drop("ord", "error")
    return citation_order(good, listed, version), found.filter("error is not null").count()


def index(spark: SparkSession, stores: list[Store], out: str, langs: tuple[str, ...] = DEFAULT_LANGS, sources: dict[str, str] | None = None, trees: list[str] | None = None, lemma_map: DataFrame | None = None, guess: bool = False) -> tuple[Index, dict]:
    """Builds and publishes the index of the stores' sidecars, and of sidecar trees, which come after the stores."""
    rows, broken = (sidecar_rows(stores), 0) if stores else (None, 0)
    if trees:
        more, broken = tree_rows(spark, trees)
        more = more.withColumn("root", F.col("root") + len(stores))
        columns = ["root", "version_path", "citation_key", "urn", "lang", "tokens", "meta_base_urn", "title", "author", "source_repo"]
        key = lambda df: df.withColumn("citation_key", F.col("citation_key").cast(more.schema["citation_key"].dataType))
        rows = more.select(*columns) if rows is None else key(rows).select(*columns).unionByName(more.select(*columns))
    built = build_index(rows, langs, lemma_map=lemma_map, guess=guess)
    return built, publish(spark, built, out, langs, sources, {"broken_sidecars": broken} if trees else None)


def export(store: Store, root: str) -> int:
    """The store's sidecars, indexes and metadata as a tree of files, written by the tasks; returns their number.

    Indexes and metadata that came with a tree are copied byte by byte, others are made.
    """
    sidecars, chunks, beside = store.read("sidecars", SIDECARS), store.read("chunks", CHUNKS), store.read("beside", BESIDE)
    copied = beside.select("version_path", F.col("name").alias("sidecar"), F.col("content").alias("payload"))
    made = version_files(store.read("works", WORKS), chunks).join(copied.select("version_path", "sidecar"), ["version_path", "sidecar"], "left_anti")
    return export_tree(pack_sidecars(sidecars).unionByName(made).unionByName(copied), root)


def run(spark: SparkSession, corpus_root: str, store: Store, model: Callable[[], Analyzer], versions: dict[str, str], force: bool = False, prune: bool = False, time_budget_minutes: float | None = None, manifest: str | None = None, source_repo: str | None = None) -> dict:
    """Compile and tokenize under one time budget; writes a record of the run, and returns it with an exit status.

    What became of every source file stands in a JSON table beside the record, which names it.
    """
    started = time.time()
    deadline = None if time_budget_minutes is None else time.monotonic() + 60 * time_budget_minutes
    works = compile_corpus(spark, corpus_root, store, force=force, source_repo=source_repo)
    place = f"{store.base}/_works/{time.time_ns()}"
    works.write.json(place)
    statuses = {r["status"]: r["n"] for r in works.groupBy("status").agg(F.count("*").alias("n")).collect()}
    counts = tokenize(spark, store, model, versions, force=force, prune=prune, deadline=deadline)
    record = {"corpus_root": corpus_root, "base": store.base, "started": started, "finished": time.time(), "works": place, "statuses": statuses, "tokenize": counts}
    put_text(spark, manifest or f"{store.base}/_run-manifest.json", json.dumps(record, ensure_ascii=False, indent=1, default=str))
    failed = counts["failed"] + statuses.get("failed", 0)
    return record | {"exit_status": int(failed > 0)}
