"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch: in round i every shingle is hashed into one of t bins; a bin keeps the first round that reached it, and the
smallest hash of that round.  Rounds t to 2t-1 put all shingles into bin i-t, so every bin is filled in the end, for sets
of any size, and the share of equal bins of two sketches concentrates around their Jaccard similarity.

Bands of 4 bins lead sets into buckets.  Sets are first compared with the smallest document of each bucket; links join
them into components.  Only in buckets that still hold several components are other pairs looked at, in blocks, by their
sketches, and those that may be similar are compared there; what a pair of blocks gives are links that connect, not pairs.  Every link is confirmed on full shingle sets from whole texts.
A pair at the threshold misses all 32 bands with a probability of 5e-6, and the look at the sketches with 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.components import components
from lexforge.llm.staging import staged, unstage
from lexforge.llm.texts import map_batches, map_texts
from lexforge.llm.wordhash import SPACED, U, Words, pieces, splitmix

SHINGLE, BINS, BAND = 5, 128, 4
BANDS = BINS // BAND
#: Sketches with fewer equal bins than this share are taken to be under the threshold: five deviations under 0.75.
MAYBE = 0.55
#: Documents and, about, shingles in one of the two blocks that a worker holds; pairs with one pivot in one part.
BLOCK, BLOCK_SHINGLES, PER_PIVOT = 512, 1 << 19, 256


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and hash of every distinct shingle, by document, and each document's first place."""
    at, g = words.grams(SHINGLE)
    doc = words.doc[at]
    n = np.diff(words.first)
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    if few.size:
        doc = np.concatenate([doc, few])
        g = np.concatenate([g, np.array([words.whole(d) for d in few], dtype=U)])
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.ones(g.size, dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    doc, g = doc[new], g[new]
    return doc, g, np.searchsorted(doc, np.arange(words.n_docs + 1))


def sketches(doc: np.ndarray, g: np.ndarray, n_docs: int, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketches, 16 bits a bin, of shape (n_docs, bins); documents without shingles have zeros."""
    best = np.full(n_docs * bins, np.iinfo(np.uint64).max, dtype=U)
    open_docs = np.zeros(n_docs, dtype=bool)
    open_docs[doc] = True
    for i in range(2 * bins):
        if i:
            live = open_docs[doc]
            doc, g = doc[live], g[live]
        if not doc.size:
            break
        x = splitmix(g + U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        bin_ = (x & U(bins - 1)).astype(np.int64) if i < bins else np.full(x.size, i - bins)
        np.minimum.at(best, doc * bins + bin_, (U(i) << U(54)) | (x >> U(10)))
        open_docs = (best.reshape(n_docs, bins) == np.iinfo(np.uint64).max).any(axis=1) & open_docs
    code = (splitmix(best) & U(0xFFFF)).astype(np.uint16).reshape(n_docs, bins)
    code[(best.reshape(n_docs, bins) == np.iinfo(np.uint64).max)] = 0
    return code


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, words in pieces(batch.column(1), SPACED):
            doc, g, first = shingle_sets(words)
            n = np.diff(first)
            sums = []
            for salt in (1, 2):
                total = np.concatenate([np.zeros(1, dtype=U), np.cumsum(splitmix(g ^ U(salt * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF)), dtype=U)])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            flat = sketches(doc, g, b - a).view(np.int64).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * BANDS, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), lists], names=["doc_id", "n_shingles", "h1", "h2", "sketch"])


def _similar(s: np.ndarray, h: np.ndarray, share: tuple[int, int]) -> bool:
    """Whether two sorted sets meet in share[0]/share[1] of their union."""
    small, large = (s, h) if s.size <= h.size else (h, s)
    if not small.size or share[1] * small.size < share[0] * large.size:
        return False
    where = np.minimum(np.searchsorted(large, small), large.size - 1)
    both = int((large[where] == small).sum())
    return share[1] * both >= share[0] * (s.size + h.size - both)


def _verify(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Rows (p, part, role, id, text) by p, part and role, the pivot's text first; gives pairs that are linked."""
    held: list[np.ndarray] = []
    at = None
    for batch in batches:
        own, links = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)), []
        for a, b, words in pieces(batch.column(4), SPACED):
            _, g, first = shingle_sets(words)
            for k in range(a, b):
                p, part, role, x = own[k]
                s = g[first[k - a] : first[k - a + 1]]
                if (p, part) != at:
                    at, held = (p, part), []
                if role == 0:
                    held.append(s.copy())
                    continue
                if any(_similar(s, h, share) for h in held):
                    links.append((x, p))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([p for _, p in links], pa.int64())], names=["a", "b"])


def _with_texts(rows: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """``rows`` with the texts of the documents in column ``name``.

    A bit map of hashed ids, of at most 2^18 words, keeps most other texts out of the shuffle; the join decides.
    """
    at = lambda c: F.shiftrightunsigned(F.xxhash64(c), 40)
    bits = rows.select(at(F.col(name)).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
    texts = docs.withColumn("at", at(F.col("doc_id"))).withColumn("word", F.shiftright("at", 6)).join(F.broadcast(bits), "word")
    texts = texts.filter(F.expr("bits & shiftleft(1L, cast(at & 63 as int)) != 0")).select(F.col("doc_id").alias(name), "text")
    return rows.hint("merge").join(texts, name)


def _confirmed(pairs: DataFrame, docs: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Those of the distinct pairs (x, p) whose full sets are similar enough, staged.  A pivot's pairs are dealt out in parts."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = pairs.groupBy("p").agg(F.count("*").alias("n")).repartition(n, "p", "n")
    dealt = pairs.join(counts, "p").withColumn("part", F.pmod(F.xxhash64("x"), F.ceil(F.col("n") / PER_PIVOT)).cast("int"))
    dealt = staged(dealt.select("p", "part", "x"), "pairs")
    wanted = dealt.select("p", "part", F.lit(1).alias("role"), F.col("x").alias("id")).unionByName(dealt.select("p", "part", F.lit(0).alias("role"), F.col("p").alias("id")).distinct())
    rows = _with_texts(wanted, docs, "id").select("p", "part", "role", "id", "text")
    sorted_rows = rows.repartition(n, "p", "part").sortWithinPartitions("p", "part", "role", "id")
    out = staged(map_batches(sorted_rows, lambda it: _verify(it, share), "a bigint, b bigint"), "links")
    unstage(dealt)
    return out


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (key, i, j) at a time; they are the first three columns, and rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
        cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if a < b:
                if held and tuple(keys[a]) != at:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held = []
                at = tuple(keys[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class _Cell:
    """Two blocks of one bucket: for a row of the first, rows of the second to compare it with.

    Those are in another component, have enough equal bins, and share no earlier band, so that a pair is met once.
    """

    def __init__(self, t: pa.Table):
        self.block, self.rep, self.comp = (t[c].to_numpy() for c in ("block", "rep", "comp"))
        self.bands = np.array(t["sketch"].chunk(0).flatten()).reshape(-1, BANDS)
        self.bins = self.bands.view(np.uint16).reshape(-1, BINS)
        self.band, i, j = t["band"][0].as_py(), t["i"][0].as_py(), t["j"][0].as_py()
        self.one, self.two, self.twice = np.flatnonzero(self.block == i), np.flatnonzero(self.block == j), i == j

    def partners(self, k: int) -> np.ndarray:
        other = self.two[(self.comp[self.two] != self.comp[k]) & ((self.rep[self.two] > self.rep[k]) | (not self.twice))]
        other = other[(self.bins[other] == self.bins[k]).sum(axis=1) >= MAYBE * BINS]
        return other[~(self.bands[other, : self.band] == self.bands[k, : self.band]).any(axis=1)]


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells that have anything to be compared with."""
    for t in _by_cell(batches):
        cell, wanted = _Cell(t), np.zeros(t.num_rows, dtype=bool)
        for k in cell.one.tolist():
            near = cell.partners(k)
            wanted[near] = True
            wanted[k] |= near.size > 0
        if wanted.any():
            yield from t.filter(pa.array(wanted)).combine_chunks().to_batches()


def _settle(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Cells with texts: compares what is not connected yet, and gives links that connect it."""
    for t in _by_cell(batches):
        cell, sets = _Cell(t), []
        for _, _, words in pieces(t["text"].chunk(0), SPACED):
            _, g, first = shingle_sets(words)
            sets += [g[first[d] : first[d + 1]].copy() for d in range(words.n_docs)]
        a, b = [], []
        for k in cell.one.tolist():
            for m in cell.partners(k).tolist():
                if cell.comp[k] != cell.comp[m] and _similar(sets[k], sets[m], share):
                    a.append(int(cell.rep[k]))
                    b.append(int(cell.rep[m]))
                    lo, hi = sorted((cell.comp[k], cell.comp[m]))
                    cell.comp = np.where(cell.comp == hi, lo, cell.comp)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: tuple[int, int] = (75, 100)) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) for each row of ``df``.

    Words: `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a set holds distinct runs of five words, or the whole of fewer.
    Documents whose sets meet in ``share[0]``/``share[1]`` of their union are linked; equal sets are one node.  Null,
    empty and blank texts have no shingles and stay alone.  Rows that repeat a doc_id are one node.  An empty table gives
    an empty one; other columns are not read.  Rows with a null id keep it as their component.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = staged(map_texts(docs, _sketch, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, sketch array<bigint>"), "sets")
    same = ["h1", "h2", "n_shingles"]
    full = sets.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = staged(full.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")), "reps")

    bands = reps.select("rep", "n_shingles", F.posexplode("sketch").alias("band", "bins")).select(F.xxhash64("band", "bins").alias("key"), "band", "rep", "n_shingles")
    pivots = bands.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("pivot")).filter("size > 1").repartition(n, "key", "pivot")
    met = staged(bands.join(pivots, "key"), "buckets")
    links = _confirmed(met.filter("rep != pivot").select(F.col("rep").alias("x"), F.col("pivot").alias("p")).distinct(), docs, share)
    comps = components(links)

    apart = met.filter("size > 2 and rep != pivot").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("key", "band", "rep", "n_shingles", F.coalesce("component", "rep").alias("comp"))
    apart = staged(apart, "apart")
    # the largest component of a bucket needs no look at itself: its rows meet those of the rest, and the rest meet all
    by_comp = apart.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    by_key = by_comp.groupBy("key").agg(F.max(F.struct("n", "comp", "shingles")).alias("most"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles"), F.count("*").alias("comps"))
    blocks = lambda n, shingles: F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    rest = blocks(F.col("n") - F.col("most.n"), F.col("shingles") - F.col("most.shingles"))
    mixed = by_key.filter("comps > 1").select("key", F.col("most.comp").alias("main"), blocks(F.col("most.n"), F.col("most.shingles")).alias("a"), rest.alias("b")).repartition(n, "key", "main")
    rows = apart.join(mixed, "key").withColumn("inner", F.col("comp") == F.col("main"))
    rows = rows.withColumn("block", F.when(F.col("inner"), F.pmod(F.xxhash64("rep"), "a")).otherwise(F.col("a") + F.pmod(F.xxhash64("rep"), "b")).cast("int"))
    rows = rows.drop("n_shingles").join(reps.select("rep", "sketch"), "rep")
    other = F.explode(F.sequence(F.when(F.col("inner"), F.col("a")).otherwise(0), F.col("a") + F.col("b") - 1)).alias("other")
    cells = rows.select("*", other).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "band", "rep", "comp", "sketch")
    columns = "key bigint, i int, j int, block int, band int, rep bigint, comp bigint, sketch array<bigint>"
    in_order = lambda df: df.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    open_cells = staged(map_batches(in_order(cells), _look, columns), "cells")
    late = staged(map_batches(in_order(_with_texts(open_cells, docs, "rep").select(*[c.split()[0] for c in columns.split(", ")], "text")), lambda it: _settle(it, share), "a bigint, b bigint"), "links")
    if not late.isEmpty():
        first = comps
        comps = components(late.unionByName(first.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        unstage(first)
    for t in (met, links, apart, open_cells, late):
        unstage(t)

    named = reps.drop("sketch").join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    linked = full.drop("sketch").join(named, same, "left").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = sets.filter((F.col("n_shingles") == 0) | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
