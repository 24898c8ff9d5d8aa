"""Command line: lexforge pipeline | tokenize | analyze | index | check."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lexforge.operators import search
from lexforge.operators.languages import profiled
from lexforge.plans import pipeline
from lexforge.plans.analyzers import PlainAnalyzer, named_analyzer
from lexforge.plans.publish import analyze_tables, open_published, parse_sources
from lexforge.sources.sidecars import read_corpora


def _versions() -> dict[str, str]:
    from importlib.metadata import PackageNotFoundError, version

    out = {}
    for name in ("spacy", "stanza", "la_core_web_lg", "grc_dep_web_lg"):
        try:
            out[name] = version(name.replace("_", "-"))
        except PackageNotFoundError:
            out[name] = "none"
    return out


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexforge", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("pipeline", "tokenize", "analyze"):
        c = commands.add_parser(name)
        if name == "pipeline":
            c.add_argument("--corpus-root", required=True)
            c.add_argument("--manifest")
            c.add_argument("--registry", help="a JSON list of corpora")
            c.add_argument("--corpus", help="the name of this corpus in the registry, whose repository documents then name")
        if name == "tokenize":
            c.add_argument("--proto-dir", help="a tree of chunk files to take in first")
        c.add_argument("--base", default="tokenized-pages", help="folder of chunks, manifest and sidecars")
        how = c.add_mutually_exclusive_group(required=True)
        how.add_argument("--analyzer", metavar="MODULE:CLASS", help="the model to use")
        how.add_argument("--plain-lang", help="use the offline tokenizer, for texts in this language")
        c.add_argument("--profiles", help="a Parquet table of language profiles, which tell languages in place of the analyzer")
        c.add_argument("--tokens-dir", help="write the sidecars as a tree of files too")
        c.add_argument("--force", action="store_true")
        if name != "analyze":
            c.add_argument("--prune", action="store_true")
            c.add_argument("--time-budget-minutes", type=float)
    c = commands.add_parser("index")
    c.add_argument("--base", action="append", default=[])
    c.add_argument("--tokens-dir", action="append", default=[], help="a tree of sidecar files")
    c.add_argument("--lemma-map", help="a Parquet table (text, lang, lemma, upos, feats)")
    c.add_argument("--guess-lemmas", action="store_true", help="words that the dictionary of lemmas doesn't have follow the endings of those that it has")
    c.add_argument("--out", required=True)
    c.add_argument("--langs", default="grc,la")
    c.add_argument("--source", action="append", default=[], metavar="NAME=VALUE")
    c.add_argument("--analyze", metavar="PREFIX", help="register the tables under this prefix, with statistics for the optimizer")
    c = commands.add_parser("check")
    c.add_argument("out")
    c.add_argument("--key", default="μῆνις")
    c.add_argument("--lang", default="grc")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = _parser()
    a = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("lexforge").getOrCreate()
    if a.command == "index":
        stores = [pipeline.Store(spark, b) for b in a.base]
        if not stores and not a.tokens_dir:
            parser.error("--base or --tokens-dir is needed")
        lemmas = spark.read.parquet(a.lemma_map) if a.lemma_map else None
        _, manifest = pipeline.index(spark, stores, a.out, tuple(x.strip() for x in a.langs.split(",") if x.strip()), parse_sources(a.source), a.tokens_dir, lemmas, a.guess_lemmas)
        if a.analyze:
            analyze_tables(spark, open_published(spark, a.out)[0], a.analyze)
        print(json.dumps(manifest, ensure_ascii=False))
        return 0
    if a.command == "check":
        index, manifest = open_published(spark, a.out)
        found = search.check(index, a.key, a.lang, manifest)
        print(json.dumps(found))
        return int(not all(found.values()))
    store = pipeline.Store(spark, a.base)
    lang = a.plain_lang
    model = (lambda: PlainAnalyzer(lang)) if lang else named_analyzer(a.analyzer, a.command == "analyze")
    if a.profiles:
        model = profiled(spark.read.parquet(a.profiles), model)
    if a.command == "analyze":
        counts = pipeline.analyze(spark, store, model, a.force)
    elif a.command == "tokenize":
        if a.proto_dir:
            print(json.dumps(pipeline.import_tree(spark, a.proto_dir, store, a.force)), file=sys.stderr)
        deadline = None if a.time_budget_minutes is None else time.monotonic() + 60 * a.time_budget_minutes
        counts = pipeline.tokenize(spark, store, model, _versions(), a.force, a.prune, deadline)
    else:
        repo = None
        if a.registry and a.corpus:
            found = read_corpora(spark, a.registry).filter(F.col("name") == a.corpus).head()
            if found is None:
                parser.error(f"{a.registry} has no corpus {a.corpus}")
            repo = f"{found['repo_owner']}/{found['repo_name']}"
        record = pipeline.run(spark, a.corpus_root, store, model, _versions(), a.force, a.prune, a.time_budget_minutes, a.manifest, repo)
        counts, status = record["tokenize"], record["exit_status"]
    if a.tokens_dir:
        pipeline.export(store, a.tokens_dir)
    print(json.dumps(counts))
    return status if a.command == "pipeline" else int(counts["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())
