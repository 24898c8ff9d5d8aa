"""Benchmark decontamination by winnowing.

Of each 8 consecutive 6-word hashes the smallest (the last of equal ones) is kept as a fingerprint, so any 13 words that
two texts share leave them the same fingerprint at the same place.  Fingerprints of documents and benchmark items are
joined, and each hit is extended to the runs of 13 words around it; those that an item has are contamination.  Items of fewer
words have one fingerprint, of the whole item, which every run of as many document words is held against.  Items are joined
by what they have in common, and listed when that is known, so that a template of many items is extended once.

A bit map of fixed size drops document fingerprints that no item has before they leave the scan; what it lets through by
chance goes at the join, so that its size bears on speed alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.staging import staged
from lexforge.llm.texts import map_texts
from lexforge.llm.wordhash import ALNUM, U, Words, pieces, splitmix

WINDOW, GRAM = 13, 6
MAP_BITS = 24
#: Benchmark fingerprints up to this number are broadcast (about 50 MB); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
_KIND = U(0xD1B54A32D192ED03)
_MULT = U(0x2545F4914F6CDD1D)


def winnow(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of the fingerprints of all documents with ``window`` words or more."""
    at, g = words.grams(gram)
    span = window - gram + 1
    m = g.size - span + 1
    if m <= 0:
        return at[:0], g[:0]
    least, where = g[:m].copy(), np.zeros(m, dtype=np.int64)
    for j in range(1, span):
        smaller = g[j : j + m] <= least
        least[smaller] = g[j : j + m][smaller]
        where[smaller] = j
    doc = words.doc[at]
    picked = np.zeros(g.size, dtype=bool)
    picked[(np.arange(m) + where)[doc[:m] == doc[span - 1 :]]] = True
    return at[picked], g[picked]


def _windows(words: Words, at: np.ndarray, k: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``size`` words that hold the k words at ``at``: their number, their hashes, and the place of the k words in the first."""
    doc = words.doc[at]
    a = np.maximum(at + k - size, words.first[doc])
    n = np.minimum(at, words.first[doc + 1] - size) - a + 1
    starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - a, n)
    g = np.zeros(starts.size, dtype=U)
    for j in range(size):
        g *= _MULT
        g += words.h[starts + j]
    return n, splitmix(g), at - a


def _fingerprints(words: Words, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, int]]:
    """kind, first words, fingerprints, words in each, words that must agree around them."""
    at, g = winnow(words)
    yield 0, at, g, GRAM, WINDOW
    for n in lengths:
        at, g = words.grams(n)
        with np.errstate(over="ignore"):
            yield n, at, g ^ (U(n) * _KIND), n, n


_HIT = pa.struct([("kind", pa.int32()), ("fp", pa.int64()), ("at", pa.int64()), ("off", pa.int32()), ("windows", pa.list_(pa.int64()))])
_HIT_SQL = "struct<kind:int,fp:bigint,at:bigint,off:int,windows:array<bigint>>"


def _scan(batches: Iterator[pa.RecordBatch], lengths: list[int], bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(id, key, row, n_words, found) of each row; ``bits``: keep fingerprints of this map only; None: all, and short items whole."""
    for batch in batches:
        for a, b, words in pieces(batch.column(1), ALNUM):
            n = np.diff(words.first)
            parts = []
            for kind, at, g, k, size in _fingerprints(words, lengths):
                if bits is not None:
                    keep = bits[(g >> U(64 - MAP_BITS)).astype(np.int64)]
                else:
                    keep = (n[words.doc[at]] == kind) if kind else np.ones(g.size, dtype=bool)
                at, g = at[keep], g[keep]
                if at.size:
                    sizes, around, off = _windows(words, at, k, size)
                    doc = words.doc[at]
                    parts.append((doc, np.full(at.size, kind), g, at - words.first[doc], off, sizes, around))
            if parts:
                doc, kind, g, at, off, sizes = (np.concatenate([p[i] for p in parts]) for i in range(6))
                around = np.concatenate([p[6] for p in parts])
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(around.view(np.int64)))
                order = np.argsort(doc, kind="stable")
                hits = pa.StructArray.from_arrays([pa.array(kind, pa.int32()), pa.array(g.view(np.int64)), pa.array(at, pa.int64()), pa.array(off, pa.int32()), lists], fields=list(_HIT)).take(pa.array(order))
                counts = np.bincount(doc, minlength=b - a)
            else:
                hits, counts = pa.array([], _HIT), np.zeros(b - a, dtype=np.int64)
            found = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), hits)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in (0, 2, 3)], pa.array(n, pa.int64()), found], names=["doc_id", "key", "row", "n_words", "found"])


def bit_map(fps: DataFrame) -> np.ndarray:
    """A map of fixed size over the leading bits of the fingerprints; at most 2^(MAP_BITS-6) words reach the driver."""
    word = F.shiftrightunsigned("fp", 70 - MAP_BITS)
    bit = F.shiftrightunsigned("fp", 64 - MAP_BITS).bitwiseAND(63)
    rows = fps.select(word.alias("word"), F.expr("1L").alias("one"), bit.cast("int").alias("bit")).groupBy("word").agg(F.expr("bit_or(shiftleft(one, bit))").alias("bits")).collect()
    out = np.zeros(1 << (MAP_BITS - 6), dtype=np.uint64)
    for r in rows:
        out[r["word"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _windows_of_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows (kind, fp, window, a, b) and classes (a, b, item_id): a window is in the items of its class.

    Windows of the same items are one class, so what a document shares with all items of a template is one row.  A class
    is named by two hashes of its items, which add up before any shuffle; no list of items is built.
    """
    found = items.select(F.col("doc_id").alias("item_id"), F.explode("found").alias("f"))
    own = staged(found.select("item_id", "f.kind", "f.fp", F.explode("f.windows").alias("window")).distinct(), "item-windows")
    named = [F.bit_xor(F.xxhash64("item_id", F.lit(k))).alias(n) for k, n in enumerate("ab")]
    windows = staged(own.groupBy("kind", "fp", "window").agg(*named), "windows")
    one = windows.groupBy("a", "b").agg(F.min(F.struct("kind", "fp", "window")).alias("w")).select("a", "b", "w.*")
    return windows, own.join(one, ["kind", "fp", "window"]).select("a", "b", "item_id")


def _shared(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, row, n_words, a, b, start, end) of what documents share with items, by class; and the classes.

    Each hit is extended to the windows of 13 words around it, and counts where an item has one of them at that
    fingerprint.  Rows without any have nulls.
    """
    own = F.xxhash64(F.col(text_col).cast("string")).alias("key")
    row, none = F.monotonically_increasing_id().alias("row"), F.lit(0).cast("long")
    columns = f"doc_id bigint, key bigint, row bigint, n_words bigint, found array<{_HIT_SQL}>"
    scan = lambda lens, bits: lambda batches: _scan(batches, lens, bits)
    windows, classes = _windows_of_items(map_texts(benchmark, scan(list(range(1, WINDOW)), None), columns, item_col, item_text, (none.alias("key"), none.alias("row"))))
    kinds = {r["kind"]: r["n"] for r in windows.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(bit_map(windows)))
    short = sorted(set(kinds) - {0})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, short, np.unpackbits(bits.value).astype(bool))

    found = map_texts(docs, run, columns, id_col, text_col, (own, row))
    rows = found.select("doc_id", "key", "row", "n_words", F.explode_outer("found").alias("f")).select("doc_id", "key", "row", "n_words", "f.*")
    rows = rows.select("doc_id", "key", "row", "n_words", "kind", "fp", "at", "off", F.posexplode_outer("windows").alias("nth", "window"))
    if sum(kinds.values()) <= BROADCAST_ROWS:
        windows = F.broadcast(windows)
    else:  # documents without a fingerprint must not meet in one task
        rows = rows.withColumn("kind", F.coalesce("kind", F.lit(-1))).withColumn("fp", F.coalesce("fp", "key"))
        rows = rows.withColumn("window", F.coalesce("window", "row"))
    start = F.when(F.col("a").isNotNull(), F.col("at") - F.col("off") + F.col("nth"))
    size = F.when(F.col("kind") == 0, F.lit(WINDOW)).otherwise(F.col("kind"))
    return rows.join(windows, ["kind", "fp", "window"], "left").select("doc_id", "key", "row", "n_words", "a", "b", start.alias("start"), (start + size).alias("end")), classes


def contamination_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, key, row, item_id, start, end): document words start..end (exclusive), 13 or a whole shorter item, stand in an item.

    ``key`` is a hash of the text, for documents that share an id, and ``row`` a number of the document's row within this
    result.  An item with a null id has hits with a null ``item_id``.  Longer spans are runs of rows that overlap.
    """
    shared, classes = _shared(docs, benchmark, id_col, text_col, item_col, item_text)
    return shared.filter("start is not null").distinct().join(classes, ["a", "b"]).select("doc_id", "key", "row", "item_id", "start", "end").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, key) for each row of ``docs``; ``key`` is a hash of the text.

    Words: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z.  Repeated rows give repeated results.  Null and
    empty texts have no words and are clean; an empty benchmark leaves all clean; an empty table gives an empty one.
    Items that repeat an id are one item; hits of an item with a null id count in ``n_hit`` and not in ``n_items``.  Other
    columns are not read.  Hits compare 64-bit hashes of words, of 6 words and of 13.

    Documents that share the same classes of windows have the same items, which are listed once for all of them.
    """
    shared, classes = _shared(docs, benchmark, id_col, text_col, item_col, item_text)
    span = F.when(F.col("start").isNotNull(), F.struct("start", "end"))
    which = F.when(F.col("start").isNotNull(), F.struct("a", "b"))
    by_doc = shared.groupBy("row", "doc_id", "key", "n_words").agg(F.collect_set(span).alias("spans"), F.array_sort(F.collect_set(which)).alias("classes"))
    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(zero.alias("upto"), zero.alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), (acc["n"] + F.greatest(zero, s["end"] - F.greatest(s["start"], acc["upto"]))).alias("n")),
        lambda acc: acc["n"],
    )
    counted = staged(by_doc.select("doc_id", "key", "n_words", covered.alias("n_hit"), "classes", F.xxhash64("classes").alias("one"), F.xxhash64("classes", F.lit(1)).alias("two")), "contaminated")
    hit = counted.filter("n_hit > 0")
    sets = hit.groupBy("one", "two").agg(F.first("classes").alias("classes")).select("one", "two", F.explode("classes").alias("c")).select("one", "two", "c.*")
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    items = sets.join(classes, ["a", "b"]).groupBy("one", "two").agg(F.collect_set("item_id").alias("items"))
    items = items.select("one", "two", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "key"]
    clean = counted.filter("n_hit = 0").select("*", zero.alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"))
    out = hit.join(items, ["one", "two"]).select(columns).unionByName(clean.select(columns))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
