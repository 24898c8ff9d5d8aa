"""Citation declarations: nested books and lines, milestones, positions, and what is not understood."""

from __future__ import annotations

import pytest

from lexforge.sources.citation import steps
from lexforge.sources.tei import _chunks

TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>T</title><author>A</author></titleStmt></fileDesc>
<encodingDesc>{decl}</encodingDesc></teiHeader><text><body xml:base="urn:cts:x:a.b.c">{body}</body></text></TEI>"""


def cited(decl: str, body: str, **more) -> dict:
    return _chunks(TEI.format(decl=f"<refsDecl xml:id='CTS'>{decl}</refsDecl>", body=body).encode(), more.get("unit"))


def refs(decl: str, body: str, **more) -> list[tuple[str, str]]:
    got = cited(decl, body, **more)
    assert got["error"] is None, got
    return [(c["ref"], " ".join(c["text"].split())) for c in got["chunks"]]


BOOK = '<citeStructure match="/TEI/text/body/div[@type=\'edition\']/div[@subtype=\'book\']" use="@n" unit="book">{}</citeStructure>'
LINE = '<citeStructure match=".//l" use="@n" unit="line" delim="."/>'


def test_books_and_lines():
    body = '<div type="edition" n="urn:cts:x:a.b.c"><head>no</head><div subtype="book" n="1"><head>h</head><lg><l n="1">arma</l><l n="2a">virum<note>s</note></l></lg></div><div subtype="book" n="2"><l n="1">cano</l><l>without</l></div><div n="9">other</div></div>'
    assert refs(BOOK.format(LINE), body) == [("1", "h"), ("1.1", "arma"), ("1.2a", "virums"), ("2", "without"), ("2.1", "cano")]
    assert refs(BOOK.format(LINE.replace('"."', '":"')), body)[1][0] == "1:1"
    got = cited(BOOK.format(LINE), body)
    assert (got["base_urn"], got["title"], got["author"]) == ("urn:cts:x:a.b.c", "T", "A")


def test_milestones_stand_for_what_follows():
    decl = '<citeStructure match="//div" use="@n"><citeStructure match=".//milestone[@unit=\'section\']" use="@n" delim="."><citeStructure match=".//lb" use="position()" delim="-"/></citeStructure></citeStructure>'
    body = '<div n="1">before<p><milestone unit="section" n="1"/>a <milestone unit="page" n="7"/>b</p><p>c<milestone unit="section" n="2"/>d<lb/>e<lb/>f</p></div><div n="2"><p>g<milestone unit="section" n="1"/>h</p></div>'
    assert refs(decl, body) == [("1", "before"), ("1.1", "a bc"), ("1.2", "d"), ("1.2-1", "e"), ("1.2-2", "f"), ("2", "g"), ("2.1", "h")]


def test_positions_prefixes_and_attributes():
    decl = '<citeStructure match="//tei:div[@type=\'textpart\' and @n]" use="@n"><citeStructure match="p" use="position()"/></citeStructure><citeStructure match="/TEI/text/body/*[local-name()=\'ab\']" use="@xml:id"/>'
    body = '<div type="textpart" n="a"><p>x</p><q><p>not a child</p></q><p>y</p></div><div n="b"><p>no</p></div><ab xml:id="i">z</ab>'
    assert refs(decl, body) == [("a", "not a child"), ("a.1", "x"), ("a.2", "y"), ("i", "z")]  # by where a unit begins


def test_without_a_path_divs_count_and_a_unit_may_be_named():
    body = '<div n="1"><div n="1"><p>x</p></div><div n="2"><p>y</p></div></div><div n="2">z</div>'
    assert refs("<citeStructure/>", body) == [("1.1", "x"), ("1.2", "y"), ("2", "z")]
    assert refs('<citeStructure match="//nothing" use="@n"/>', "<p n='1'>a</p><p n='2'>b</p>", unit="p") == [("1", "a"), ("2", "b")]


def test_the_declaration_named_cts_counts():
    two = "<refsDecl><citeStructure match='//div' use='@n'/></refsDecl><refsDecl xml:id='CTS'><citeStructure match='//p' use='@n'/></refsDecl>"
    got = _chunks(TEI.format(decl=two, body="<div n='1'><p n='7'>x</p></div>").encode(), None)
    assert [c["ref"] for c in got["chunks"]] == ["7"]


@pytest.mark.parametrize("decl", ['<citeStructure match="//div[1]" use="@n"/>', '<citeStructure match="//div" use="concat(@n, 1)"/>', '<citeStructure match="//other" use="@n"/>', '<citeStructure match="//div | //p" use="@n"/>'])
def test_what_is_not_understood_or_cites_nothing_is_an_error(decl):
    got = cited(decl, '<div n="1">x</div>')
    assert got["error"] and not got["chunks"]


def test_paths():
    assert [(s.anywhere, s.name) for s in steps("/TEI//body/tei:div", True)] == [(False, "TEI"), (True, "body"), (False, "div")]
    assert [(s.anywhere, s.name) for s in steps("div", True)] == [(True, "div")] and [(s.anywhere, s.name) for s in steps("./div", False)] == [(False, "div")]
