"""Token counts by overlap resynchronisation.

A huge document is encoded in overlapping chunks with offsets.  Two neighbouring chunks are spliced at a position where
both end the same word with the same token, begin the same next word, and hold that word whole with something after it.
From there on both scans read the same characters, and neither the normaliser nor the pre-tokenizer looks back, so the
spliced tokens are those of the whole text.  Where no such position exists, the overlap is widened, then the chunk.
Other documents go through a table of words that the library has encoded, or to the library itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexforge.llm.bpe import WordIds
from lexforge.llm.texts import map_texts, strings

CHUNK_CHARS, OVERLAP_CHARS = 16_384, 512


class Resync:
    """Ids of huge texts from overlapping chunks."""

    def __init__(self, words: WordIds, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        longest = max((len(s) for s in words.splitter.special), default=0)
        self.tokenizer, self.chunk, self.overlap = words.tokenizer, chunk, max(overlap, 4 * longest)
        self.closes = words.ends.copy()
        for s in words.splitter.special:
            self.closes[self.tokenizer.token_to_id(s)] = True
        self.sound = words.splitter.known
        self.widened = 0

    def _scan(self, text: str, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        e = self.tokenizer.encode(text[a:b], add_special_tokens=False)
        return np.array(e.ids, dtype="<u4"), np.array(e.offsets, dtype=np.int64).reshape(-1, 2) + a

    def _splice(self, left: tuple, right: tuple) -> tuple[int, int] | None:
        """Indices in both chunks of the first token of a word from which the right chunk takes over."""
        (li, lo), (ri, ro) = left, right
        ends = np.flatnonzero(self.closes[li])
        for i, close in zip(ends[:-1][::-1] + 1, ends[1:][::-1], strict=True):  # words i..close of the left chunk, the last first
            if close + 1 >= li.size or lo[i, 0] < lo[i - 1, 1]:  # at the chunk's end, or inside a character that became two
                continue
            if lo[i, 0] < ro[0, 0]:
                break
            j = int(np.searchsorted(ro[:, 0], lo[i, 0]))
            n = close - i + 1
            while j and ro[j - 1, 0] == lo[i, 0]:
                j -= 1
            if 0 < j <= ri.size - n and (li[i - 1 : close + 1] == ri[j - 1 : j + n]).all() and (lo[i - 1 : close + 1] == ro[j - 1 : j + n]).all():
                return int(i), j
        return None

    def ids(self, text: str) -> np.ndarray:
        if not self.sound or len(text) <= self.chunk:
            return self._scan(text, 0, len(text))[0]
        out, a, size, overlap = [], 0, self.chunk, self.overlap
        b = min(a + size, len(text))
        left = self._scan(text, a, b)
        while b < len(text):
            c = max(a + 1, b - overlap)
            right = self._scan(text, c, d := min(c + size, len(text)))
            if right[0].size and left[0].size and (at := self._splice(left, right)):
                out.append(left[0][: at[0]])
                left = right[0][at[1] :], right[1][at[1] :]
                a, b, size, overlap = int(left[1][0, 0]), d, self.chunk, self.overlap
            else:
                self.widened += 1
                overlap *= 2
                if overlap >= b - a:
                    size *= 2
                    overlap = self.overlap
                    b = min(a + size, len(text))
                    left = self._scan(text, a, b)
        return np.concatenate([*out, left[0]])


@lru_cache(maxsize=2)
def _counter(path: str, chunk: int, overlap: int):
    words = WordIds(path)
    return words, Resync(words, chunk, overlap)


def _count(texts: list[str], path: str, chunk: int, overlap: int) -> list[int]:
    if path.endswith(".model"):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(x) for x in p.encode(texts, num_threads=1)]
    words, resync = _counter(path, chunk, overlap)
    short = words.pack(["" if len(t) > chunk else t for t in texts])
    return [resync.ids(t).size if len(t) > chunk else len(p) // 4 for t, p in zip(texts, short, strict=True)]


def count_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """One row (doc_id, n_bytes, n_tokens, over_limit) for each row of ``df``, counting without added special tokens.

    ``tokenizer_path``: a .json of the tokenizers library, or a .model of sentencepiece (encoded whole).  A null or empty
    text has 0 bytes and 0 tokens.  Repeated rows give repeated results, an empty table an empty one; columns other than
    ``id_col`` and ``text_col`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column(1))
            n = _count(texts, tokenizer_path, chunk_chars, overlap_chars)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return map_texts(df, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", id_col, text_col)
