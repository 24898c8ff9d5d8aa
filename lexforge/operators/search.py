"""Lookups in an index: keys to forms and lemmas, postings, hits with URNs, counts, and words in context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.keys import fold_text
from lexforge.functions.names import hit_urn
from lexforge.operators.index import CLUSTERING, PUSHED, Index
from lexforge.schema import CONTEXT_PART, TOKEN_SEP


def few(rows: DataFrame, *columns: str) -> list[tuple] | None:
    """The rows' columns if there are at most PUSHED rows; reading ends where there are more."""
    found = rows.select(*columns).limit(PUSHED + 1).collect()
    return None if len(found) > PUSHED else [tuple(r) for r in found]


def fenced(index: Index, table: str, values: list) -> list:
    """Fences of the files that may hold rows under some values of the table's first key, in the order of their keys."""
    index[table]  # a table that is written when it is asked for has its fences then
    low, high = ("low_text", "high_text") if values and isinstance(values[0], str) else ("low_id", "high_id")
    inside = F.exists(F.lit(values), lambda v: (v >= F.col(low)) & (v <= F.col(high)))
    return index.fences.filter((F.col("name") == table) & inside).orderBy(low, "low_next").collect()


def opened(index: Index, table: str, files: list[str]) -> DataFrame:
    """A table from some of its files alone."""
    whole = index[table]
    return whole.sparkSession.read.schema(whole.schema).parquet(*[f"{index.path}/{table}/{f}" for f in files]) if files else whole.filter(F.lit(False))


def narrowed(index: Index, table: str, values: list) -> DataFrame:
    """Rows under some values of the table's first key: of a written index only files that may hold them are opened, and the values are pushed into their scan."""
    rows = index[table] if not index.fenced or not values else opened(index, table, [f["file"] for f in fenced(index, table, values)])
    return rows.filter(F.col(CLUSTERING[table][0]).isin(values))


def _under(index: Index, table: str, ids: DataFrame, name: str) -> DataFrame:
    """Rows of a table for some ids, pushed where they are few, else joined; an index that is not written makes these rows alone."""
    if table in index.under:
        return index.under[table](ids)
    wanted = few(ids, name)
    return index[table].join(ids.select(name).distinct(), name, "left_semi") if wanted is None else narrowed(index, table, sorted({w for (w,) in wanted if w is not None}))


def lookup(index: Index, kind: str, text: str, lang: str, loose: bool = False) -> DataFrame:
    """Rows of ``forms`` or ``lemmas`` under the key of what was typed."""
    key = fold_text(text, lang, loose)
    if loose and f"{kind}_by_loose" not in index.tables:
        return index[kind].filter((F.col("loose") == key) & (F.col("lang") == lang))
    return narrowed(index, f"{kind}_by_loose" if loose else kind, [key]).filter(F.col("lang") == lang)


def postings(index: Index, kind: str, ids: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Postings of some form_id or lemma_id rows.

    An index that is not written makes only the ``columns`` asked for, among which may be the ``form``; a written one has its own.
    """
    if columns and f"{kind}_postings" in index.under:
        return index.under[f"{kind}_postings"](ids, columns)
    return _under(index, f"{kind}_postings", ids, f"{kind}_id")


def postings_page(index: Index, kind: str, ids: DataFrame, after: tuple[int, int] | None = None, limit: int = 100) -> DataFrame:
    """The next ``limit`` postings in reading order after (chunk_id, seq); the last row's pair is where the next page begins.

    A file holds a stretch of an id's postings in reading order, so of a written index only as many files are read as the
    page needs: one for each id at first, then more for the ids that have not filled it.
    """
    name, table = f"{kind}_id", f"{kind}_postings"
    beyond = F.lit(True) if after is None else (F.col("chunk_id") > after[0]) | ((F.col("chunk_id") == after[0]) & (F.col("seq") > after[1]))
    wanted = few(ids, name) if index.fenced else None
    if wanted is None:
        return postings(index, kind, ids).filter(beyond).orderBy("chunk_id", "seq").limit(limit)
    values = sorted({w for (w,) in wanted if w is not None})
    fences = fenced(index, table, values) if values else []
    passed = lambda f, v: after is not None and f["high_id"] == v and f["high_next"] < after[0]
    left = {v: [f["file"] for f in fences if f["low_id"] <= v <= f["high_id"] and not passed(f, v)] for v in values}
    files: list[str] = []
    step = 1
    while short := [v for v in values if left[v]]:
        for v in short:
            files += [f for f in left[v][:step] if f not in files]
            left[v] = left[v][step:]
        rows = opened(index, table, files).filter(F.col(name).isin(values) & beyond)
        filled = {r[name] for r in rows.groupBy(name).count().filter(F.col("count") >= limit).collect()} if any(left.values()) else set()
        left = {v: [] if v in filled else [f for f in left[v] if f not in files] for v in values}
        step *= 2
    return opened(index, table, files).filter(F.col(name).isin(values) & beyond).orderBy("chunk_id", "seq").limit(limit)


def hits(index: Index, found: DataFrame) -> DataFrame:
    """Postings with doc_id, form (which they may have) and the citable URN; sort by chunk_id and seq for reading order."""
    if "form" in found.columns:
        rows = found.join(index["chunks"], "chunk_id").join(index["documents"].select("doc_id", "base_urn"), "doc_id")
        return rows.withColumn("urn", hit_urn(F.col("base_urn"), F.col("ref"), F.col("form"), F.col("occ")))
    ids = few(found, "chunk_id", "form_id") if index.fenced else None
    if ids is None:
        chunks, docs, forms = index["chunks"], index["documents"], index["forms"]
    else:
        chunks = narrowed(index, "chunks", sorted({c for c, _ in ids}))
        docs = _under(index, "documents", chunks, "doc_id")
        forms = narrowed(index, "forms_by_id", sorted({f for _, f in ids}))
    rows = found.join(chunks, "chunk_id").join(docs.select("doc_id", "base_urn"), "doc_id").join(forms.select("form_id", "form"), "form_id")
    return rows.withColumn("urn", hit_urn(F.col("base_urn"), F.col("ref"), F.col("form"), F.col("occ")))


def hits_in_document(index: Index, found: DataFrame, documents: DataFrame) -> DataFrame:
    """Postings within some documents: ranges of chunks that go into the scan where documents are few, else a join through the chunk's document."""
    spans = few(documents, "doc_id", "first_chunk", "last_chunk")
    if spans is None:
        return found.join(index["chunks"].join(documents.select("doc_id").distinct(), "doc_id", "left_semi").select("chunk_id", "doc_id"), "chunk_id")
    place, within = F.lit(None).cast("long"), F.lit(False)
    for doc, first, last in sorted(set(spans)):
        inside = F.col("chunk_id").between(first, last)
        place, within = F.when(inside, doc).otherwise(place), within | inside
    return found.filter(within).withColumn("doc_id", place.cast("long"))


def counts_by_document(index: Index, kind: str, ids: DataFrame) -> DataFrame:
    """(id, doc_id, n) for some form_id or lemma_id rows, without touching postings."""
    return _under(index, f"{kind}_doc_counts", ids, f"{kind}_id")


def per_work_counts(index: Index, kind: str, ids: DataFrame) -> DataFrame:
    """Occurrences by document, without touching postings."""
    return counts_by_document(index, kind, ids).groupBy("doc_id").agg(F.sum("n").alias("n")).join(index["documents"].select("doc_id", "base_urn", "n_words"), "doc_id")


def with_feats(index: Index, found: DataFrame) -> DataFrame:
    """Postings with upos and feats, null where there are none."""
    return found.join(index["feats"], "feat_id", "left")


def in_context(index: Index, found: DataFrame, around: int = 5, width: int = CONTEXT_PART) -> DataFrame:
    """Hits with ``before``, ``word`` and ``after``: up to ``around`` tokens on each side, from one to three windows."""
    need = found.withColumn("_part", F.explode(F.sequence(F.floor(F.greatest(F.col("seq") - around, F.lit(0)) / width).cast("int"), F.floor((F.col("seq") + around) / width).cast("int"))))
    keys = [c for c in found.columns]
    contexts = _under(index, "chunk_context", found, "chunk_id") if index.fenced or "chunk_context" in index.under else index["chunk_context"]
    rows = need.join(contexts.withColumnRenamed("part", "_part"), ["chunk_id", "_part"])
    whole = rows.groupBy(*keys).agg(F.min("_part").alias("_low"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "tokens"))), lambda x: x["tokens"]), TOKEN_SEP).alias("_text"))
    at = (F.col("seq") - F.col("_low") * width).cast("int")
    tokens = F.split("_text", TOKEN_SEP, -1)
    start = F.greatest(at - around, F.lit(0))
    return whole.select(*keys, F.array_join(F.slice(tokens, start + 1, at - start), "").alias("before"), F.get(tokens, at).alias("word"), F.array_join(F.slice(tokens, at + 2, F.lit(around)), "").alias("after"))


def lemma_coverage(index: Index) -> DataFrame:
    """Words, those that have a lemma, and whether that is over a half of them, by the dictionaries' counts."""
    words = index["forms"].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words"))
    lemmas = index["lemmas"].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("with_lemma"))
    return words.crossJoin(lemmas).withColumn("covered", F.col("with_lemma") > 0.5 * F.col("words"))  # single rows


def check(index: Index, key: str, lang: str, manifest: dict | None = None) -> dict[str, bool]:
    """Integrity of a built index: ranges tile the chunks, counts agree (with the manifest too), lemmas cover enough words, a key is found."""
    docs = index["documents"].agg(F.sum(F.col("last_chunk") - F.col("first_chunk") + 1).alias("chunks"), F.sum("n_words").alias("words")).head()
    forms = index["forms"].agg(F.sum("n").alias("n")).head()["n"]
    told = {} if manifest is None else {"manifest": all(index[t].count() == n for t, n in manifest["tables"].items()) and manifest["words"] == docs["words"]}
    return told | {
        "documents": (docs["words"] or 0) > 0,
        "chunk_ranges": docs["chunks"] == index["chunks"].count(),
        "form_counts": forms == docs["words"] == index["form_doc_counts"].agg(F.sum("n").alias("n")).head()["n"],
        "lemma_coverage": bool(lemma_coverage(index).head()["covered"]),
        "key_found": not lookup(index, "lemmas", key, lang).isEmpty(),
    }
