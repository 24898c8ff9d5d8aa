"""Byte-pair encoding by dynamic programming over prefixes, and a word table in front of a tokenizer library.

A sequence of tokens is what BPE gives exactly when each token encodes to itself and each neighbouring pair encodes to
itself.  So every prefix of a word has one last token: among the tokens that end there, the one that is compatible with
the last token of the prefix it leaves.  ``PrefixCoder`` stores that token for every prefix and follows the pointers back.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
from tokenizers import Tokenizer

#: Fixed values of the vocabulary file: the pattern of its pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters only: composed, and the same letters, digits and spaces in every Unicode version.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡§«°»¿À-ÖØ-öø-ÿ‐-―‘-„…€]*")
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
_END = "\0"
_NEVER = 1 << 40


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordSplitter:
    """Words of a text as the vocabulary's normaliser and pre-tokenizer give them, for texts where plain patterns do this exactly."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.spec = spec
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.known = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and pre[0].get("pattern") == {"Regex": SPLIT} and spec["model"].get("end_of_word_suffix") == "</w>"

    def words(self, text: str) -> list[str] | None:
        """None: the text needs the library's own normaliser (other scripts, special strings, another kind of vocabulary)."""
        if not self.known or not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return None
        return _WORD.findall(text.lower())


class WordIds(dict):
    """Word -> its ids packed as little-endian unsigned 32-bit integers, from the library.  At most ``limit`` words stay."""

    def __init__(self, path: str, limit: int = 700_000):
        self.tokenizer = load(path)
        self.splitter = WordSplitter(path)
        self.limit = limit
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends[[i for t, i in names.items() if t.endswith("</w>")]] = True

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def learn(self, words: set[str]) -> None:
        """Encodes new words in one call, parted by spaces, which no word of these vocabularies crosses."""
        if len(self) + len(words) > self.limit:
            self.clear()
        new = list(words)
        ids = self._encode(" ".join(new))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if cuts.size != len(new):
            raise ValueError("a word was not encoded on its own")
        packed, at = ids.tobytes(), 0
        for w, cut in zip(new, (cuts * 4).tolist(), strict=True):
            self[w] = packed[at:cut]
            at = cut

    def pack(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        split = [self.splitter.words(t) for t in texts]
        out = [None if w is None else list(map(self.get, w)) for w in split]
        short = [k for k, got in enumerate(out) if got is not None and None in got]
        if new := {w for k in short for w, x in zip(split[k], out[k], strict=True) if x is None}:
            self.learn(new)
        for k in short:
            out[k] = [x or self[w] for w, x in zip(split[k], out[k], strict=True)]
        return [self._encode(t).tobytes() if got is None else b"".join(got) for t, got in zip(texts, out, strict=True)]


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """The library's tokenizer, single-threaded, without truncation and padding."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class PrefixCoder:
    """Encodes words by the last token of every prefix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model.get("end_of_word_suffix") != "</w>" or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("a byte-level vocabulary with word ends is needed")
        vocab: dict[str, int] = model["vocab"]
        self.letters = byte_letters()
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = vocab[a], vocab[b]
            self.rank.setdefault(pair, rank)
            made.setdefault(vocab[a + b], (rank, *pair))
        self.tail: dict[int, list[tuple[int, int]]] = {}
        self.head: dict[int, list[tuple[int, int]]] = {}
        self.match = ahocorasick.Automaton()
        self.names = {i: t for t, i in vocab.items()}
        for token, i in sorted(vocab.items(), key=lambda x: made.get(x[1], (-1,))[0]):
            rank, left, right = made.get(i, (-1, -1, -1))
            if rank >= 0:
                if left not in self.tail or right not in self.tail or not self._apart(left, right, rank):
                    continue  # BPE never leaves this token
                self.tail[i] = [(i, _NEVER), (right, rank), *self.tail[right][1:]]
                self.head[i] = [(i, _NEVER), (left, rank), *self.head[left][1:]]
            else:
                self.tail[i] = self.head[i] = [(i, _NEVER)]
            plain = token.removesuffix("</w>")
            body = plain + _END if plain != token and plain else token
            self.match.add_word(body, (i, len(body)))
        self.match.make_automaton()
        self._pairs: dict[tuple[int, int], bool] = {}

    def _apart(self, left: int, right: int, before: int = _NEVER) -> bool:
        """Whether BPE makes no merge across the boundary of ``left`` and ``right`` (of a rank under ``before``).

        A piece at the boundary lives until the merge that takes it into its parent; two such pieces merge if their pair
        comes first.  Equal ranks go from left to right.
        """
        rank = self.rank
        for x, gone_x in self.tail[left]:
            for y, gone_y in self.head[right]:
                r = rank.get((x, y), _NEVER)
                if r < before and r < gone_x and r <= gone_y and r != _NEVER:
                    return False
        return True

    def word(self, body: str) -> list[int]:
        """Ids of one word, given lower-cased text without spaces."""
        return self.mapped("".join([self.letters[b] for b in body.encode()]))

    def mapped(self, body: str) -> list[int]:
        """Ids of one word in the letters that stand for its bytes."""
        pairs = self._pairs
        text = body + _END
        n = len(text)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        for end, (token, length) in self.match.iter(text):
            at = end + 1
            if last[at] >= 0 or at == n - 1:
                continue
            if length < at:
                before = last[at - length]
                if before < 0:
                    continue
                fits = pairs.get((before, token))
                if fits is None:
                    if len(pairs) > 400_000:
                        pairs.clear()
                    fits = pairs[before, token] = self._apart(before, token)
                if not fits:
                    continue
            last[at], size[at] = token, length
        out, at = [], n
        while at > 0:
            if last[at] < 0:
                raise ValueError("no encoding")
            out.append(last[at])
            at -= size[at]
        return out[::-1]
