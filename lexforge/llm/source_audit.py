"""Source divergence audit: how far the word use of each source of a language lies from the others and from the language.

Terms are found on bytes: a lookup table over the concatenated UTF-8 buffers of many texts marks the bytes of terms, its
changes are the boundaries, xxhash groups the slices, and every slice is compared with the first of its group byte by byte.
Counts are sparse matrices of sources by terms, in cells of bounded size; divergences are sums over row segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from lexforge.llm.staging import staged
from lexforge.llm.texts import map_batches
from lexforge.llm.wordhash import spans_of

#: Terms in fewer documents of their language are not compared.
LEAST_DOCS = 10
#: Bytes of text that are tokenized at once, and rows that a task holds before it adds them up and passes them on.
RUN_BYTES, PENDING_ROWS = 2 << 20, 1 << 18
#: Rows of one cell of a language's matrix, about.
CELL_ROWS = 1 << 17
SCALE = 1_000_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Terms of `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`: ASCII letters and all beyond ASCII.
IN_TERM = np.zeros(256, dtype=bool)
IN_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _bytes_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of slices, one after another."""
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if ends.size else 0)]


def _strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(starts.size + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.StringArray.from_buffers(starts.size, pa.py_buffer(offsets), pa.py_buffer(_bytes_of(data, starts, sizes)))


def term_slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes and text numbers of all terms of texts that stand one after another in ``data``."""
    inside = np.zeros(data.size + 1, dtype=bool)
    inside[:-1] = IN_TERM[data]
    before = np.zeros(data.size + 1, dtype=bool)
    before[1:] = inside[:-1]
    edge = np.zeros(data.size + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    texts = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends - starts, texts


def grouped(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, digest=xxh3_64_intdigest) -> tuple[np.ndarray, np.ndarray]:
    """(first slice of each distinct term, number of the term of each slice), exact whatever the hashes collide on."""
    raw = memoryview(data.tobytes())
    hashes = np.fromiter(map(digest, map(raw.__getitem__, map(slice, starts.tolist(), (starts + sizes).tolist()))), dtype=np.uint64, count=starts.size)
    _, first, term = np.unique(hashes, return_index=True, return_inverse=True)
    lead = first[term]
    same = sizes[lead] == sizes
    # slices of an equal size are compared with the first of their group, byte by byte
    at = np.flatnonzero(same & (lead != np.arange(starts.size)))
    if at.size:
        differ = _bytes_of(data, starts[at], sizes[at]) != _bytes_of(data, starts[lead[at]], sizes[at])
        bounds = np.cumsum(sizes[at]) - sizes[at]
        same[at] = ~np.logical_or.reduceat(differ, bounds)
    other: dict[bytes, int] = {}
    for k in np.flatnonzero(~same).tolist():
        text = bytes(raw[starts[k] : starts[k] + sizes[k]])
        if text not in other:
            other[text] = first.size
            first = np.append(first, k)
        term[k] = other[text]
    return first, term


def _runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, offsets) of consecutive texts; a text longer than a run comes in several, cut between terms."""
    a, n = 0, offsets.size - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + RUN_BYTES, side="right")) - 1)
        low, high = int(offsets[a]), int(offsets[b])
        if high - low <= RUN_BYTES:
            yield a, data[low:high], offsets[a : b + 1] - low
        while high - low > RUN_BYTES:
            cut = low + RUN_BYTES
            while cut < high and IN_TERM[data[cut]]:
                cut += 1
            yield a, data[low:cut], np.array([0, cut - low])
            low = cut
            if high - low <= RUN_BYTES:
                yield a, data[low:high], np.array([0, high - low])
        a = b


def _tables(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Counts of a batch: rows (lang, source, term, occurrences, texts), and a row without a term for each group."""
    langs, sources = batch.column(0), batch.column(1)
    names: dict[tuple[str, str], int] = {}
    group = np.array([names.setdefault(k, len(names)) for k in zip(langs.to_pylist(), sources.to_pylist(), strict=True)], dtype=np.int64)
    lang_of, source_of = (pa.array([k[j] for k in names], pa.string()) for j in (0, 1))
    none = pa.nulls(len(names), pa.string())
    zero = pa.array(np.zeros(len(names), dtype=np.int64))
    yield pa.table([lang_of, source_of, none, zero, zero], schema=_ARROW)
    data, offsets = spans_of(batch.column(2))
    seen_text, seen = -1, set()
    for first_text, raw, bounds in _runs(data, offsets):
        low = _LOWER[raw]
        starts, sizes, texts = term_slices(low, bounds)
        if not starts.size:
            continue
        first, term = grouped(low, starts, sizes)
        pairs, n = np.unique(texts * first.size + term, return_counts=True)
        text, word = pairs // first.size, pairs % first.size
        new = np.ones(pairs.size, dtype=np.int64)
        if bounds.size == 2:
            # a long text comes in several runs, and counts once for each of its terms
            own = [bytes(low[starts[k] : starts[k] + sizes[k]]) for k in first[word].tolist()]
            if first_text != seen_text:
                seen_text, seen = first_text, set()
            new = np.array([x not in seen for x in own], dtype=np.int64)
            seen.update(own)
        codes, at = np.unique(group[first_text + text] * first.size + word, return_inverse=True)
        count, docs = np.bincount(at, n).astype(np.int64), np.bincount(at, new).astype(np.int64)
        of, word = codes // first.size, codes % first.size
        terms = _strings(low, starts[first], sizes[first]).take(pa.array(word))
        yield pa.table([lang_of.take(pa.array(of)), source_of.take(pa.array(of)), terms, pa.array(count), pa.array(docs)], schema=_ARROW)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (lang, source, term, n occurrences, docs rows that hold the term), one for each; a row with a null term for every (lang, source).

    Null text, lang and source are empty strings; every row is a document of its own, repeated rows too.
    """

    def added_up(tables: list[pa.Table]) -> list[pa.RecordBatch]:
        out = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return out.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(_ARROW.names).cast(_ARROW).to_batches(max_chunksize=1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held += _tables(batch)
            if sum(t.num_rows for t in held) > PENDING_ROWS:
                yield from added_up(held)
                held = []
        if held:
            yield from added_up(held)

    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(x) for c, x in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return map_batches(texts, run, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), digit group by digit group, so that nothing leaves 64 bits."""
    size = f"({total} + 2 * {kept})"
    out, rest = f"(({n} + 2) * 1000 div {size})", f"(({n} + 2) * 1000 % {size})"
    for _ in range(2):
        out, rest = f"({out} * 1000 + {rest} * 1000 div {size})", f"({rest} * 1000 % {size})"
    return F.expr(f"1 + {out}")


def _shares(n: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """``_share`` for arrays."""
    out, rest = np.divmod((n + 2) * 1000, size)
    for _ in range(2):
        more, rest = np.divmod(rest * 1000, size)
        out = out * 1000 + more
    return out + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)), exact: shares stay under 2^30."""
    return (p - q) ** 2 // (p + q)


def cell_divergences(counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of one cell, for every two sources of its language.

    ``counts`` (source, term, n) as a CSR matrix; a source's row is laid out densely once, the others' entries are held
    against it and summed up row by row; where neither has the term, all terms add the same.
    """
    groups = groups.sort_values("source", ignore_index=True)
    names, m = groups["source"].to_numpy(), len(groups)
    size = (groups["n_group"] + 2 * groups["kept"]).to_numpy(dtype=np.int64)
    none = _shares(np.zeros(m, dtype=np.int64), size) if len(counts) else np.zeros(m, dtype=np.int64)
    row = np.searchsorted(names, counts["source"].to_numpy())
    _, col = np.unique(counts["term"].to_numpy(), return_inverse=True)
    width = int(col.max()) + 1 if len(col) else 0
    order = np.lexsort((col, row))
    row, col = row[order], col[order]
    p = _shares(counts["n"].to_numpy(dtype=np.int64)[order], size[row]) if width else np.empty(0, dtype=np.int64)
    indptr = np.searchsorted(row, np.arange(m + 1))
    filled = np.flatnonzero(np.diff(indptr))
    total = np.zeros((m, m), dtype=np.int64)
    for k in range(m if width else 0):
        own, at = p[indptr[k] : indptr[k + 1]], col[indptr[k] : indptr[k + 1]]
        dense = np.full(width, none[k], dtype=np.int64)
        dense[at] = own
        total[k] = (width - own.size) * _apart(none[k], none)
        for a in range(0, own.size, step := max(1, (1 << 20) // m)):
            total[k] += _apart(own[a : a + step, None], none[None, :]).sum(axis=0)
        if filled.size:
            other = dense[col]
            total[k, filled] += np.add.reduceat(_apart(p, other) - _apart(none[row], other), indptr[filled])
    a, b = np.nonzero(~np.eye(m, dtype=bool))
    return pd.DataFrame({"lang": groups["lang"].iloc[0] if m else "", "source": names[a], "item": names[b], "value": total[a, b]})


def divergences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = 10) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair`` against each other source, ``term`` for what a source overuses.

    A language keeps the terms of at least ``least_docs`` of its rows; a group's share of a term is smoothed and scaled to
    whole numbers, and value is floor((p - q)^2 / (p + q)), summed over all kept terms in ``pair``, of one term whose share
    exceeds the language's in ``term``, where the ``top`` highest stay.  Ranks count from 1 by value, then by item (UTF-8).
    Null text, lang and source are empty strings and may form groups; a group without terms has pairs, and no terms; a
    language that keeps no term gives pairs of value 0; an empty table gives none.  Repeated rows count each; columns
    beyond the three named are not read.
    """
    found = staged(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    words = found.filter(F.col("term").isNotNull())
    kept = staged(words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang_term")).filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    cells = staged(words.drop("docs").join(kept, ["lang", "term"]), "term-cells")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang_term").alias("n_lang"))
    held = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count("*").alias("rows"))
    groups = found.filter(F.col("term").isNull()).select("lang", "source").join(held, ["lang", "source"], "left").join(langs, "lang", "left")
    spans = F.floor(F.sum(F.coalesce("rows", F.lit(0))).over(Window.partitionBy("lang")) / F.lit(CELL_ROWS)) + 1
    groups = staged(groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_group", "kept", "n_lang")], spans.cast("long").alias("cells")), "groups")

    placed = cells.join(groups.select("lang", "cells").distinct(), "lang").select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), F.col("cells")).alias("cell"))
    every = groups.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))).drop("n_lang", "cells")
    schema = "lang string, source string, item string, value bigint"
    parts = placed.groupBy("lang", "cell").cogroup(every.groupBy("lang", "cell")).applyInPandas(lambda x, y: cell_divergences(x, y), schema)
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    shares = cells.join(groups, ["lang", "source"]).withColumn("p", _share("n", "n_group", "kept")).withColumn("q", _share("n_lang_term", "n_lang", "kept"))
    terms = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(order)) for df, part in ((pairs, "pair"), (terms, "term"))]
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked[0].select(columns).unionByName(ranked[1].filter(F.col("rank") <= top).select(columns))
