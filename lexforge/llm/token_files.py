"""Token-id files: each document's ids as one zstandard frame under a shared dictionary, in blocks with an offset index.

A file set is a folder with two Parquet tables.  ``blocks`` holds one row per block of some MB: the task's part and the
block's place in it, the range of document ids, the number of tokens before it in its part, the dictionary's sha256, the
index (int64 document ids, then uint32 token counts, then uint32 frame ends, all little-endian) and the frames one after
another.  ``dictionary`` holds the dictionary under its sha256.  Parts ascend by document id.  The container keeps the
files readable from any store that Spark reads; one short document costs its block's row and one frame.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.bpe import WordIds
from lexforge.llm.texts import map_batches, strings

BLOCK_BYTES = 4 << 20
#: The dictionary is trained on this many different texts at most, and as many ids of each, from a drawn place.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 1000, 2048, 64 << 10
#: The library trains none that is smaller, and says this where samples are too few.
LEAST_DICTIONARY, TOO_FEW = 256, "Src size is incorrect"
LEVEL = 3
_NO_ID = -(1 << 63)
BLOCKS = "part int, block int, first_doc bigint, last_doc bigint, n_docs bigint, n_tokens bigint, start_in_part bigint, dict_sha256 string, index binary, data binary"


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    return WordIds(path)


def train_dictionary(docs: DataFrame, tokenizer_path: str) -> bytes:
    """A zstandard dictionary from the ids of SAMPLE_DOCS different texts, those with the smallest hashes, each from a drawn place.

    Texts too few or too short to train one are the dictionary themselves, as raw content; it is empty only where no text
    has ids.
    """
    texts = docs.filter(F.length("text") > 0).select(F.xxhash64("text").alias("hash"), "text")
    least = [r["hash"] for r in texts.select("hash").distinct().orderBy("hash").limit(SAMPLE_DOCS).collect()]
    if not least:
        return b""
    width = 4 * SAMPLE_IDS
    place = F.pmod(F.shiftrightunsigned("hash", 7), F.greatest(F.length("text") - width + 1, F.lit(1)).cast("long")).cast("int") + 1
    drawn = texts.filter(F.col("hash") <= least[-1]).groupBy("hash").agg(F.min(F.substr("text", place, F.lit(width))).alias("text")).orderBy("hash").collect()
    samples = [x[:width] for x in WordIds(tokenizer_path).pack([r["text"] for r in drawn]) if x]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if size >= LEAST_DICTIONARY:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError as e:
            if TOO_FEW not in str(e):
                raise
    return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> None:
    """Writes the ids of every row's whole text, each followed by ``end_id``, in ascending id order (ties: by a hash of the text).

    Null and empty texts are written as the end id alone; repeated rows are all written; an empty table gives empty
    files; rows with a null id come first.  Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    raw = train_dictionary(docs, tokenizer_path)
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pack = _words(tokenizer_path), zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, **_dictionary(raw))
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            index = np.array([_NO_ID if i is None else i for i in ids], dtype="<i8").tobytes() + np.array(counts, dtype="<u4").tobytes() + np.cumsum([len(f) for f in frames]).astype("<u4").tobytes()
            known = [i for i in ids if i is not None]
            row = [part, block, min(known, default=None), max(known, default=None), len(ids), sum(counts), before, digest, index, b"".join(frames)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), words.pack(strings(batch.column(1))), strict=True):
                frame = pack.compress(packed + end)
                ids.append(i)
                counts.append(len(packed) // 4 + 1)
                frames.append(frame)
                held += len(frame)
                if held >= BLOCK_BYTES:
                    yield close()
                    block, before = block + 1, before + sum(counts)
                    ids, counts, frames, held = [], [], [], 0
        if ids:
            yield close()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id are spread by their texts, and copies of one row by chance
    order = ["doc_id", "hash", "at"]
    dealt = docs.withColumn("hash", F.xxhash64("text")).withColumn("at", F.rand(7)).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("hash", "at")
    map_batches(dealt, run, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _load_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    r = spark.read.parquet(f"{path}/dictionary").head()
    raw = bytes(r["dictionary"])
    if hashlib.sha256(raw).hexdigest() != r["dict_sha256"]:
        raise ValueError("the dictionary is damaged")
    return r["dict_sha256"], raw


def _frames(index: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(index, dtype="<i8", count=n)
    return ids, np.frombuffer(index, dtype="<u4", count=n, offset=8 * n), np.frombuffer(index, dtype="<u4", count=n, offset=12 * n)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row (doc_id, start, n_tokens, ids_crc32) for each document in the files, decoded from its frame."""
    digest, raw = _load_dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_tokens")).collect())  # one row for each part
    base = dict(zip([t[0] for t in totals], np.concatenate([[0], np.cumsum([t[1] for t in totals])]).tolist(), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(**_dictionary(raw))
        for batch in batches:
            for r in batch.to_pylist():
                if r["dict_sha256"] != digest:
                    raise ValueError("a block was written with another dictionary")
                ids, counts, ends = _frames(r["index"], r["n_docs"])
                data, at, crcs = memoryview(r["data"]), 0, []
                for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
                    got = unpack.decompress(data[at:end])
                    if len(got) != 4 * count:
                        raise ValueError("a frame is damaged")
                    crcs.append(zlib.crc32(got))
                    at = end
                starts = base[r["part"]] + r["start_in_part"] + np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array([None if i == _NO_ID else i for i in ids.tolist()], pa.int64()), pa.array(starts, pa.int64()), pa.array(counts.astype(np.int64)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_batches(blocks, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", 4)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """Ids of one document: its block by the id range, its frame by the offset index."""
    _, raw = _load_dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    for r in blocks.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).orderBy("part", "block").toLocalIterator():
        ids, _, ends = _frames(bytes(r["index"]), r["n_docs"])
        for k in np.flatnonzero(ids == doc_id)[:1].tolist():
            frame = bytes(r["data"][int(ends[k - 1]) if k else 0 : int(ends[k])])
            return np.frombuffer(zstandard.ZstdDecompressor(**_dictionary(raw)).decompress(frame), dtype="<u4").tolist()
    return None
