"""BPE encoding and decoding with per-prefix dynamic programming (``bpe.PrefixCoder``)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lexforge.llm.bpe import PrefixCoder, WordSplitter, load
from lexforge.llm.texts import map_texts, strings


class Codec:
    """Encodes and decodes whole texts; words that were met are kept, ``limit`` at most."""

    def __init__(self, path: str, limit: int = 300_000):
        self.coder, self.splitter, self.limit = PrefixCoder(path), WordSplitter(path), limit
        if not self.splitter.known or self.splitter.spec.get("decoder") is not None:
            raise ValueError("this vocabulary needs another normaliser, pre-tokenizer or decoder")
        self.parts = load(path)
        self.names = dict(self.coder.names)
        self.special = {t["content"]: t["id"] for t in self.splitter.spec["added_tokens"]}
        self.names.update({i: s for s, i in self.special.items()})
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, tuple[str, str, int]] = {}

    def encode(self, text: str) -> list[int]:
        """Ids of a text in any script; special strings inside are special tokens."""
        words = self.splitter.words(text)
        if words is not None:
            return [i for w in words for i in self.coder.word(w)]
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                plain = self.parts.normalizer.normalize_str(part)
                for piece, _ in self.parts.pre_tokenizer.pre_tokenize_str(plain):
                    out += self.coder.mapped(piece)
        return out

    def decode(self, ids: list[int]) -> str:
        """Without a decoder of its own, a vocabulary's tokens are joined by spaces."""
        return " ".join([self.names[i] for i in ids])

    def _entry(self, ids: list[int]) -> tuple[str, str, int]:
        return " ".join(map(str, ids)), self.decode(ids), len(ids)

    def written(self, text: str) -> tuple[str, str, int]:
        """Decimal ids joined by spaces, decoded text, number of ids."""
        words = self.splitter.words(text)
        if words is None:
            return self._entry(self.encode(text))
        known = self.known
        if new := set(words).difference(known):
            if len(known) + len(new) > self.limit:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = self._entry(self.coder.word(w))
        got = [known[w] for w in words]
        return " ".join([x[0] for x in got]), " ".join([x[1] for x in got]), sum([x[2] for x in got])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_decode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """One row (doc_id, n_tokens, ids array<int>, ids_text, decoded) for each row of ``df``; without ``ids``, sha256 digests ids_sha256 and decoded_sha256 in their place.

    A null or empty text has no ids and decodes to the empty text.  Repeated rows give repeated results, an empty table
    an empty one; columns other than ``id_col`` and ``text_col`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path)
        for batch in batches:
            rows = [c.written(t) for t in strings(batch.column(1))]
            own = batch.column(0).cast(pa.int64()), pa.array([r[2] for r in rows], pa.int64())
            if ids:
                lists = pa.array([[int(i) for i in r[0].split()] for r in rows], pa.list_(pa.int32()))
                more = [lists, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())]
                names = ["doc_id", "n_tokens", "ids", "ids_text", "decoded"]
            else:
                more = [pa.array([_sha(r[k]) for r in rows], pa.string()) for k in (0, 1)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*own, *more], names=names)

    schema = "doc_id long, n_tokens long, " + ("ids array<int>, ids_text string, decoded string" if ids else "ids_sha256 string, decoded_sha256 string")
    return map_texts(df, run, schema, id_col, text_col)
