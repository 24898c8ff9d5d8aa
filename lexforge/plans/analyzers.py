"""Analyzers: the offline one, and those that a caller names.

Models are not part of this package.  One plugs in as a class with ``language`` and ``tokens`` (see ``tokenize.Analyzer``)
that makes token dicts with the fields of ``schema.TOKEN``.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

import regex

_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]")
_WORD = dict.fromkeys(("id", "deprel", "deps", "feats", "head", "lemma", "misc", "text", "upos", "xpos"))


class PlainAnalyzer:
    """Tokens by a pattern, without any morphology, in one language that the caller names."""

    ids_count_along = True

    def __init__(self, lang: str = "grc"):
        self.lang = lang

    def language(self, texts: list[str]) -> list[str]:
        return [self.lang] * len(texts)

    def tokens(self, lang: str, segments: list[str]) -> list[list[dict]]:
        return [[self._token(k, m) for k, m in enumerate(_TOKEN.finditer(s))] for s in segments]

    @staticmethod
    def _token(k: int, m) -> dict:
        own = {"start_char": m.start(), "end_char": m.end(), "id": [k], "text": m.group(), "whitespace": m.string[m.end() : m.end() + 1].isspace()}
        return own | {"words": [_WORD | {"id": k, "text": m.group()}], "misc": None, "ner": None, "identifier": None, "urn": None}


def named_analyzer(name: str, full: bool = False) -> Callable[[], object]:
    """A maker of the analyzer ``module:Class``, which is imported in every worker; ``full`` is passed on if it is true."""
    module, colon, attribute = name.partition(":")
    if not colon:
        raise ValueError(f"{name!r} is not module:Class")

    def make():
        kind = getattr(importlib.import_module(module), attribute)
        return kind(full=True) if full else kind()

    return make
