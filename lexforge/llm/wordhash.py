"""Vectorised word and n-gram hashing over the UTF-8 buffers of Arrow string columns.

Words are maximal runs of a byte class; classes hold only ASCII separators, so runs of bytes are runs of characters.
Hashes have 64 bits and depend on nothing but the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_CHUNK = 1 << 19
_MULT = U(0x9E3779B97F4A7C15)


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator, for arrays of unsigned 64-bit integers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Words of `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in lower-cased text: digits, ASCII letters and all beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BYTE = splitmix(np.arange(1, 257, dtype=U) * _MULT) | U(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS.get("p", np.empty(0)).size < n:
        size = max(n, _CHUNK + 4096)
        base = 0x5851F42D4C957F2D
        inverse = pow(base, -1, 1 << 64)
        for key, b in (("p", base), ("q", inverse)):
            out = np.full(size, b, dtype=U)
            out[0] = 1
            _POWERS[key] = np.cumprod(out, dtype=U)
    return _POWERS["p"], _POWERS["q"]


class Words:
    """Words of a run of documents: byte ``start``/``end`` in ``data``, index ``doc`` from 0, hash ``h``; ``first[d]`` is document d's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.offsets, self.n_docs = offsets, offsets.size - 1
        self.data = low = _LOWER[data]
        n = low.size
        inside = np.zeros(n + 1, dtype=bool)
        inside[:n] = kind[low]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n + 1, dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge))
        self.end = np.flatnonzero(before & (~inside | edge))
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))
        self.h = np.empty(self.start.size, dtype=U)
        a = 0
        while a < self.start.size:  # in runs of whole words, so that a long text takes few times its own size
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + _CHUNK, side="right")))
            base = self.start[a]
            first, last = self.start[a:b] - base, self.end[a:b] - base
            p, q = _powers(int(last[-1]) + 1)
            run = np.zeros(int(last[-1]) + 1, dtype=U)
            np.cumsum(_BYTE[low[base : base + last[-1]]] * p[: last[-1]], out=run[1:])
            self.h[a:b] = splitmix((run[last] - run[first]) * q[first] + (last - first).astype(U))
            a = b

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every run of ``k`` words inside one document."""
        m = self.h.size - k + 1
        if m <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=U)
        g = self.h[:m].copy()
        for j in range(1, k):
            g *= _MULT
            g += self.h[j : j + m]
        at = np.flatnonzero(self.doc[:m] == self.doc[k - 1 :])
        return at, splitmix(g[at] + U(k))

    def whole(self, d: int) -> np.uint64:
        """Hash of all words of one document, as ``grams`` gives it for that length."""
        a, b = self.first[d], self.first[d + 1]
        with np.errstate(over="ignore"):
            g = U(0)
            for x in self.h[a:b]:
                g = g * _MULT + x
            return splitmix(np.array([g + U(b - a)], dtype=U))[0]

    def text(self, a: int, b: int) -> list[str]:
        """Words a to b (exclusive) as lower-cased text."""
        return [self.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(self.start[a:b], self.end[a:b], strict=True)]


def spans_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column; nulls are empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, kind: np.ndarray, chunk: int = _CHUNK) -> Iterator[tuple[int, int, Words]]:
    """``Words`` of consecutive rows, in runs of about ``chunk`` bytes (a longer text makes a run of its own): first row, last row + 1, words."""
    data, offsets = spans_of(column)
    a, n = 0, offsets.size - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk, side="right")) - 1)
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], kind)
        a = b
