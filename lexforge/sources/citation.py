"""Citation declarations of TEI files: nested ``citeStructure`` elements as an automaton on a streaming parser.

A declaration says by a path which elements are cited, by what (an attribute or their position) and how their parts are
cited in turn.  Every open element carries the steps that its children may go on with; an element at the end of a path is
a citation, and what is cited in it begins there.  An empty element (a milestone) stands for all that follows it, up to
the next one of its kind or the end of what it stands in.  Understood are child and descendant steps, names with or
without a prefix, ``*``, and tests of attributes for presence or a value; a declaration with anything else is an error.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

_STEP = re.compile(r"(//|/)\s*(?:[\w.-]+:)?([\w.-]+|\*)((?:\s*\[[^\]]*\])*)\s*")
_TEST = re.compile(r"""^(?:\.?/?@([\w:.-]+)|local-name\(\))\s*(?:=\s*(?:"([^"]*)"|'([^']*)'))?$""")
_USE = re.compile(r"^(?:\./)?@([\w:.-]+)$")


@dataclass
class Step:
    anywhere: bool
    name: str
    tests: list[tuple[str | None, str | None]]

    def matches(self, name: str, attributes: dict[str, str]) -> bool:
        if self.name not in ("*", name):
            return False
        return all((name == value) if key is None else key in attributes and value in (None, attributes[key]) for key, value in self.tests)


def steps(match: str, top: bool) -> list[Step]:
    """The steps of a path; one at the top that doesn't begin at the root may begin anywhere, another begins below what it is part of."""
    path = match.strip().removeprefix(".")
    if not path.startswith("/"):
        path = ("//" if top else "/") + path
    out, at = [], 0
    while at < len(path):
        m = _STEP.match(path, at)
        if not m:
            raise ValueError(f"match {match!r} is not understood")
        tests = []
        for one in re.findall(r"\[([^\]]*)\]", m[3]):
            for part in re.split(r"\s+and\s+", one.strip()):
                t = _TEST.match(part.strip())
                if not t or (t[1] is None and t[2] is None and t[3] is None):
                    raise ValueError(f"test {part!r} is not understood")
                tests.append((t[1], t[2] if t[2] is not None else t[3]))
        out.append(Step(m[1] == "//", m[2], tests))
        at = m.end()
    return out


@dataclass
class Unit:
    """One ``citeStructure``: path, attribute (None: the position), delimiter, and its parts."""

    path: list[Step]
    use: str | None
    delim: str
    parts: list[Unit] = field(default_factory=list)

    @classmethod
    def declared(cls, attributes: dict[str, str], top: bool) -> Unit:
        use = attributes.get("use", "@n").strip()
        by = _USE.match(use)
        if not by and use != "position()":
            raise ValueError(f"use {use!r} is not understood")
        return cls(steps(attributes["match"], top), by[1] if by else None, attributes.get("delim", "" if top else "."))


@dataclass
class _Ref:
    """A citation: what is cited in it, the milestone that is open, and the text that stands in it alone."""

    ref: str
    unit: Unit | None
    counts: dict[int, int] = field(default_factory=dict)
    mile: _Ref | None = None
    text: list[str] = field(default_factory=list)

    def now(self) -> _Ref:
        out = self
        while out.mile is not None:
            out = out.mile
        return out


@dataclass
class _Open:
    """An open element: the citation it stands in, where its children go on, and the citation that it is itself."""

    ref: _Ref
    going: list[tuple[Unit, int, _Ref]]
    own: _Ref | None = None
    outer: _Ref | None = None
    empty: bool = True


class Cited:
    """Takes a file's elements and text in order, and gives (ref, text) in document order."""

    def __init__(self, units: list[Unit]):
        root = _Ref("", None)
        self.open = [_Open(root, [(u, 0, root) for u in units])]
        self.met: dict[str, _Ref] = {}

    def start(self, name: str, attributes: dict[str, str]) -> None:
        above = self.open[-1]
        above.empty = False
        here = _Open(above.ref, [])
        going = list(above.going)
        mile = above.ref.mile
        while mile is not None:  # what is cited within a milestone may begin anywhere after it
            going += [(u, 0, mile) for u in mile.unit.parts]
            mile = mile.mile
        found: tuple[Unit, _Ref] | None = None
        for unit, k, ref in going:
            step = unit.path[k]
            if step.anywhere:
                here.going.append((unit, k, ref))
            if step.matches(name, attributes):
                if k + 1 < len(unit.path):
                    here.going.append((unit, k + 1, ref))
                elif unit.use is None or unit.use in attributes:
                    found = unit, ref
        if found:
            self._cite(here, *found, attributes)
        self.open.append(here)

    def _cite(self, here: _Open, unit: Unit, within: _Ref, attributes: dict[str, str]) -> None:
        within.counts[id(unit)] = within.counts.get(id(unit), 0) + 1
        value = str(within.counts[id(unit)]) if unit.use is None else attributes[unit.use]
        ref = f"{within.ref}{unit.delim}{value}" if within.ref else value
        own = self.met.setdefault(ref, _Ref(ref, unit))
        own.mile = None
        here.own, here.outer, here.ref = own, within, own
        here.going += [(part, 0, own) for part in unit.parts]

    def text(self, data: str) -> None:
        here = self.open[-1]
        if data.strip():
            here.empty = False
        target = here.ref.now()
        if target.unit is not None:
            target.text.append(data)

    def end(self) -> None:
        here = self.open.pop()
        if here.own is None:
            return
        if here.empty:
            # a milestone closes those of its kind, and opens within what it is part of
            here.outer.mile = here.own
        elif here.outer.mile is not None and here.outer.mile is not here.own and here.outer.mile.unit is here.own.unit:
            here.outer.mile = None

    def chunks(self) -> list[tuple[str, str]]:
        return [(r.ref, "".join(r.text)) for r in self.met.values() if "".join(r.text).strip()]
