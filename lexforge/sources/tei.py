"""TEI sources: which files are there, which can be cited, their primary text, and their chunks.

A text is cut as its citation declaration says (see ``citation``), or at one element name, and where the declaration names
no path at ``div`` with ``n``.  The primary text is all text in document order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.sources.citation import Cited, Unit
from lexforge.sources.storage import qualified


#: So many changed files are opened by their paths; beyond that, all are scanned for them.
BY_PATH = 10_000


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Rows (path, rel_path, modified, length) of the files at any depth below a folder, without opening one."""
    top = qualified(spark, root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(top)
    return files.select("path", F.substr("path", F.lit(len(top) + 2)).alias("rel_path"), F.col("modificationTime").alias("modified"), "length")


def open_files(spark: SparkSession, root: str, pattern: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` files (path, ...) with their content: few are opened by their paths alone."""
    few = [r["path"] for r in wanted.select("path").limit(BY_PATH + 1).collect()]
    if not few:
        return wanted.withColumn("content", F.lit(None).cast("binary"))
    read = spark.read.format("binaryFile")
    if len(few) <= BY_PATH:
        files = read.load([re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in few])
    else:
        files = read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return wanted.join(files.select("path", "content"), "path")


def list_sources(spark: SparkSession, root: str) -> DataFrame:
    """Rows (path, rel_path, modified, length) of data/**/*.xml under a corpus root, without the catalogue files; none is opened."""
    files = list_files(spark, f"{root.rstrip('/')}/data", "*.xml").filter(F.substring_index("path", "/", -1) != "__cts__.xml")
    return files.withColumn("rel_path", F.concat(F.lit("data/"), "rel_path"))


def scan_sources(spark: SparkSession, root: str) -> DataFrame:
    """Rows (path, rel_path, modified, content) of data/**/*.xml under a corpus root, without the catalogue files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(f"{root.rstrip('/')}/data")
    name = F.substring_index("path", "/", -1)
    return files.filter(name != "__cts__.xml").select("path", F.regexp_extract("path", r"/(data/.*)$", 1).alias("rel_path"), F.col("modificationTime").alias("modified"), "content")


class _Found(Exception):
    pass


def _has_element(data: bytes | str, local: str) -> bool:
    """Whether an element of that local name, in any namespace, begins; broken markup is read as far as it goes, then by pattern."""
    parser = expat.ParserCreate(namespace_separator=" ")

    def start(name: str, _: dict) -> None:
        if name.rsplit(" ", 1)[-1] == local:
            raise _Found

    parser.StartElementHandler = start
    try:
        parser.Parse(data, True)
    except _Found:
        return True
    except (expat.ExpatError, ValueError, LookupError):
        text = data.decode("utf-8", "replace") if isinstance(data, bytes) else data
        text = re.sub(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", "", text, flags=re.S)
        return re.search(rf"<(?:[\w.-]+:)?{re.escape(local)}(?=[\s/>])", text) is not None
    return False


def has_element(content: Column, local: str = "citeStructure") -> Column:
    """False for null and for what is no markup."""

    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: x is not None and _has_element(bytes(x) if not isinstance(x, str) else x, local)).astype(bool)

    return run(content)


def _chunk_text(data: bytes | str) -> dict:
    """URN and primary text of a chunk file; an error without an ``elements`` child of the root."""
    depth, inside, out, urn, base, seen = 0, 0, [], None, None, False
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def start(name: str, attributes: dict) -> None:
        nonlocal depth, inside, urn, base, seen
        depth += 1
        if depth == 1:
            urn, base = attributes.get("cts_urn"), attributes.get("base_urn")
        if depth == 2 and name.rpartition(":")[2] == "elements" and not seen:
            inside, seen = depth, True

    def end(_: str) -> None:
        nonlocal depth, inside
        if inside == depth:
            inside = 0
        depth -= 1

    def text(data: str) -> None:
        if inside:
            out.append(data)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    try:
        parser.Parse(data, True)
        if urn is None or not seen:
            raise ValueError("no cts_urn" if urn is None else "no elements")
    except (expat.ExpatError, ValueError) as e:
        return {"urn": None, "base_urn": None, "primary_text": None, "error": str(e)}
    return {"urn": urn, "base_urn": base or urn.rpartition(":")[0], "primary_text": "".join(out), "error": None}


def read_chunk(content: Column) -> Column:
    """struct<urn, base_urn, primary_text, error> of a chunk file; a broken one has only its error."""

    @F.pandas_udf("struct<urn:string,base_urn:string,primary_text:string,error:string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([_chunk_text("" if x is None else x if isinstance(x, str) else bytes(x)) for x in s], columns=["urn", "base_urn", "primary_text", "error"])

    return run(content)


#: What cuts a text whose declaration says nothing: ``div`` elements within each other, by their ``n``.
def _plain_unit(name: str) -> Unit:
    unit = Unit.declared({"match": f"//{name}", "use": "@n", "delim": "."}, top=True)
    unit.parts.append(unit)
    return unit


def _chunks(data: bytes, unit: str | None) -> dict:
    """Base URN, title, author and chunks (ref, text) of a TEI file."""
    stack: list[str] = []
    declared: list[list[Unit]] = []  # for each declaration, its topmost units
    inner: list[Unit | None] = []
    named: list[bool] = []
    found = {"base_urn": None, "title": None, "author": None}
    note: str | None = None
    cited: Cited | None = None
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def start(name: str, attributes: dict) -> None:
        nonlocal note, cited
        local = name.rpartition(":")[2]
        if local == "refsDecl":
            declared.append([])
            named.append("CTS" in (attributes.get("xml:id"), attributes.get("n")))
        elif local == "citeStructure" and declared and not unit:
            one = Unit.declared(attributes, not any(inner)) if attributes.get("match") else None
            if one:
                (next((u for u in reversed(inner) if u), None) or Unit([], None, "", declared[-1])).parts.append(one)
            inner.append(one)
        n = attributes.get("n")
        if local in ("text", "body", "div") and found["base_urn"] is None:
            base = attributes.get("xml:base") or (n if (n or "").startswith("urn:") else None)
            found["base_urn"] = base.rstrip(":") if base else None
        if local == "text" and "text" not in stack:
            usable = [units for _, units in sorted(zip([not x for x in named], declared, strict=True), key=lambda x: x[0]) if units]
            cited = Cited(usable[0] if usable else [_plain_unit(unit or "div")])
            for outer in stack:
                cited.start(outer, {})
        if cited is None and local in ("title", "author") and found[local] is None:
            note, found[local] = local, ""
        stack.append(local)
        if cited is not None:
            # an edition's own URN is no citation
            cited.start(local, {k: v for k, v in attributes.items() if k != "n" or not v.startswith("urn:")})

    def end(_: str) -> None:
        nonlocal note
        local = stack.pop()
        if cited is not None:
            cited.end()
        elif local == "citeStructure" and inner:
            inner.pop()
        if local == note:
            note = None

    def text(data: str) -> None:
        if note:
            found[note] += data
        elif cited is not None:
            cited.text(data)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    try:
        parser.Parse(data, True)
        whole = [{"ref": r, "text": t} for r, t in (cited.chunks() if cited else [])]
        if not whole and any(declared):
            raise ValueError("nothing is cited as the declaration says")
    except (expat.ExpatError, ValueError) as e:
        return {**found, "chunks": [], "error": str(e)}
    return {**found, "base_urn": found["base_urn"] or "", "chunks": whole, "error": None}


def split_tei(content: Column, unit: str | None = None) -> Column:
    """struct<base_urn, title, author, chunks, error> of a TEI file, cut as it declares, or at elements ``unit`` that have an ``n``."""

    @F.pandas_udf("struct<base_urn:string,title:string,author:string,chunks:array<struct<ref:string,text:string>>,error:string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([_chunks(bytes(x or b""), unit) for x in s], columns=["base_urn", "title", "author", "chunks", "error"])

    return run(content)
