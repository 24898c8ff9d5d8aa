"""Prefix trie, source divergence audit and page text, held against versions in plain Python."""

from __future__ import annotations

import hashlib
import html
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark import cloudpickle

from lexforge.llm import html_text, prefix_trie, source_audit
from lexforge.llm.html_text import main_text, parse
from lexforge.llm.prefix_trie import borrowed_openings, turns_of
from lexforge.llm.source_audit import divergences, grouped, term_counts, term_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---- conversations


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own[conv].append((role or "", text or ""))
    share = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[: share[c]] + turns[share[c] :] for c, turns in own.items()}


def trie(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    ends = {p: ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))) for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def trie_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"turn": "owner"})  # a name that the operator uses
    out = prefix_trie.prefix_trie(borrowed_openings(turns_of(df, "conv_id", "owner", "role", "text")))
    return sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=lambda r: r[:2])


def test_trie_equals_brute_force(spark):
    rng = random.Random(5)
    said = ["a b", "c", "", " ", "x\ty z", None, "é ü"]
    rows = [(c, None if t == 0 and rng.random() < 0.2 else t, rng.choice(["user", "assistant", None]), rng.choice(said)) for c in rng.sample(range(400), 150) for t in range(rng.randint(1, 7))]
    rows += rows[:20]  # repeated rows are turns of their own
    rows += [(None, 1, "user", "of nobody"), (20, 0, "user", "left to right"), (20, 0, "user", "left to right")]
    got, want = trie_of(spark, rows), trie(rebuilt(rows))
    assert got == want and len(got) > 200


def test_trie_of_copies_long_chains_and_one_root(spark, monkeypatch):
    """A third of all conversations are copies, others grow one from another, and one is long; digests stand in short runs."""
    monkeypatch.setattr(prefix_trie, "RUN", 4)
    rows = [(20 * k, t, "user", f"w{t}") for k in range(1, 60) for t in range(5)]
    rows += [(20 * (100 + k), t, "user", f"grown {t}") for k in range(25) for t in range(k + 1)]
    rows += [(20 * (200 - k), t, "user", f"shrunk {t}") for k in range(25) for t in range(k + 1)]
    rows += [(19_000, t, "user", f"long {t % 7}") for t in range(300)]
    rows += [(5, 0, "user", "gone")]
    got, want = trie_of(spark, rows), trie(rebuilt(rows))
    assert got == want and max(r[1] for r in got) == 300


def test_trie_of_nothing_and_of_conversations_without_turns(spark):
    assert trie_of(spark, []) == []
    for c in range(1, 40):  # takes three turns of a base that isn't there, and drops its own
        if zlib.crc32(str(c).encode()) % 4 == 3:
            assert trie_of(spark, [(c, 0, "user", "x")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
            break


# ---- sources


def audit(docs: list[tuple]) -> set[tuple]:
    rows = [tuple(x or "" for x in d[1:4]) for d in docs]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) for text, _, _ in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        held = Counter(t for ts, r in zip(terms, rows, strict=True) if r[1] == lang for t in set(ts))
        kept = {t for t, n in held.items() if n >= 10}
        counts = {s: Counter() for _, ln, s in rows if ln == lang}
        for ts, (_, ln, s) in zip(terms, rows, strict=True):
            if ln == lang:
                counts[s].update(t for t in ts if t in kept)
        share = lambda c, t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        whole = sum(counts.values(), Counter())
        for s, c in counts.items():
            pairs = sorted(((-sum(apart(share(c, t), share(o, t)) for t in kept), x.encode()) for x, o in counts.items() if x != s))
            over = sorted((-apart(share(c, t), share(whole, t)), t.encode()) for t in kept if c[t] and share(c, t) > share(whole, t))[:10]
            out |= {(lang, s, part, item.decode(), -v, k) for part, found in (("pair", pairs), ("term", over)) for k, (v, item) in enumerate(found, 1)}
    return out


def corpus(seed=3, n=140):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "the an of Été ßü 漢字 x".split() for b in ("", "s", "É", "ly")]
    docs = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", ".", " 12-3 "]), rng.choice(["en", "fr"]), rng.choice("abcd")) for k in range(n)]
    return [*docs, (1, None, None, None), (2, "", "en", None), (3, "12 !!", "", "z"), *docs[:5], (4, "solo word", "la", "a"), (5, None, "la", "b")]


AUDIT = "doc_id bigint, text string, lang string, source string, term int, n int, rank string, cell int"


def test_divergences_equal_brute_force(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame([(*d, 0, 0, "", 0) for d in docs], AUDIT)
    found = lambda: [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergences(df).collect()]
    want = audit(docs)
    got = found()
    assert len(got) == len(want) and set(got) == want
    monkeypatch.setattr(source_audit, "CELL_ROWS", 8)  # many cells
    assert set(found()) == want
    assert divergences(df.limit(0)).collect() == []


def test_long_texts_count_once_for_each_term(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "RUN_BYTES", 64)
    text = "Alpha beta " * 300 + "y" * 500 + " beta é"
    df = spark.createDataFrame([(text, "en", "s"), ("beta", "en", "s"), (None, "fr", "t")], "text string, lang string, source string").coalesce(1)
    rows = {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in term_counts(df).collect()}
    assert rows == {("en", "s", "alpha"): (300, 1), ("en", "s", "beta"): (302, 2), ("en", "s", "y" * 500): (1, 1), ("en", "s", "é"): (1, 1), ("en", "s", None): (0, 0), ("fr", "t", None): (0, 0)}


def test_terms_are_told_apart_where_hashes_collide():
    data = np.frombuffer("ab ac ab é bb ac b".encode(), dtype=np.uint8)
    starts, sizes, texts = term_slices(data, np.array([0, 5, data.size]))
    said = [data[a : a + n].tobytes().decode() for a, n in zip(starts, sizes, strict=True)]
    assert said == ["ab", "ac", "ab", "é", "bb", "ac", "b"] and texts.tolist() == [0, 0, 1, 1, 1, 1, 1]
    for digest in (lambda x: 7, lambda x: len(x), lambda x: hash(bytes(x)) & 0xFFFF):
        first, term = grouped(data, starts, sizes, digest)
        assert [said[first[t]] for t in term] == said and len({said[f] for f in first}) == len(first) == 5


def test_shares_stay_exact_for_very_large_counts():
    for n, size in ((0, 2), (10**13, 10**13 + 7), (123_456_789_012, 999_999_999_999), (5, 10**15)):
        assert source_audit._shares(np.array([n]), size).tolist() == [1 + 1_000_000_000 * (n + 2) // size]


# ---- pages


class Twin(HTMLParser):
    """Text of the article of well-formed pages, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.gone, self.out = 0, 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.gone += tag in ("script", "style", "nav", "footer", "aside", "form")
        if tag in ("p", "h1", "br", "li", "div", "article"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.gone -= tag in ("script", "style", "nav", "footer", "aside", "form")
        if tag in ("p", "h1", "li", "div", "article"):
            self.out.append(" ")

    def handle_data(self, data):
        if self.inside and not self.gone:
            self.out.append(data)


def twin(page: str | None) -> str:
    t = Twin()
    t.feed(page or "")
    t.close()
    return " ".join("".join(t.out).split())


def text_of(page: str) -> str:
    return " ".join(said for said, _ in parse(page)[0])


@pytest.mark.parametrize("page, want", [
    ("<p>a&amp;b &lt;i&gt; &#233;&nbsp;x<br>y <b>bo</b>ld<!-- no <p> -->er", "a&b <i> é x y bolder"),
    ("<script>var x='<p>no</p>'</script ><p>yes<style>p{}</style> so<SCRIPT>never ends <p>", "yes so"),
    ("<nav>m</nav><article><header><h1>T</h1></header><p>one<p>two<ul><li>a<li>b</ul></article><footer>f</footer>rest", "T one two a b"),
    ("<div class='wrap with-sidebar'><article>main</article></div><div class=sidebar>s</div>", "main"),
    ("<article>main<div class=comments><article class=comment>no</article></div><span class='ad'>buy <b>now</b></span> text</article>", "main text"),
    ("<main><h1>h</h1><p>text</p><div id=related><article>other</article></div></main><p>out</p>", "h text"),
    ("<body><header>site</header><ul><li><a href=/>m1</a><li><a href=/x>m2</a></ul><p>body</p><div role=dialog>cookies</div><form>q</form><div hidden>h</div><div style='display: none'>n</div>", "body"),
    ("a < b and <3 <p title=\"x>y\">in", "a < b and <3 in"),
    ("<head><title>t</title><p>started without body</p>", "started without body"),
    ("<table><tr><td>1<td>2<tr><td>3</table>after", "1 2 3 after"),
    ("<p>open <i>never closed<p>next</div>end", "open never closed next end"),
    ("", ""), ("<nav>only</nav>", ""), ("plain", "plain"), ("<", "<"), ("<p", ""), ("</p>x<![CDATA[y]]>z", "xz"),
])
def test_pages(page, want):
    assert text_of(page) == want


def test_a_page_of_many_megabytes_takes_time_in_proportion():
    import time

    began = time.time()
    page = "<article>" + "<p>word <b>bold</b> <a href='x' title=\"y>z\">link</a> &amp; more</p>" * 100_000 + "</article>" + "<div " * 100_000 + "=\"" * 100_000
    assert len(text_of(page)) > 1_500_000
    nested = "<div><article>" + "<div>x" * 3000 + "<nav>no</nav>" + "</div>" * 3000 + "y</article></div>out"
    assert text_of(nested).split() == ["x"] * 3000 + ["y"]
    assert text_of("<div>" * 3000 + "deep" + "</p>" * 3000) == "deep"
    assert time.time() - began < 30


def pages(n=24):
    rng = random.Random(1)
    out = []
    for k in range(n):
        own = " ".join(rng.choices(["rain", "sun", "wind", "über", "cloud"], k=30))
        banner = f"<div class=x{k % 2}><p>Read our letter</p></div>"
        quoted = "<p>A passage that many quote, here and there.</p>" if k % 3 == 0 else ""
        out.append((k, f"https://User@One.example.org:80/{k}", f"<html><body class=page-{k}><div id=top>One Site <b>Online</b></div>{banner}<div class=text><h2>Title {k}</h2><p>{own}</p>{quoted}</div><div>Made in town</div></body></html>"))
    return out


def test_templates_are_what_recurs_on_a_host(spark):
    rows = pages()
    two = [(100 + k, f"http://two.example/{k}", f"<article><h1>N {k}</h1><p>text {k}</p>{'<p>A passage.</p>' if k % 3 == 0 else ''}<div>Share this page</div></article>") for k in range(20)]
    copies = [(200 + k, f"http://copies.example/{k}", "<div><p>One text under many addresses</p></div>") for k in range(30)]
    odd = [(300, None, "<p>no host</p>"), (301, "relative/path", "<p>no host</p>"), (302, "http://one.example.org/x", None), (303, "http://one.example.org/y", ""), (None, "http://small.example/1", "<p>alone</p>"), rows[0]]
    df = spark.createDataFrame([(*r, 0, "t") for r in rows + two + copies + odd], "page_id bigint, url string, html string, key int, text string")
    got = {(r["page_id"], r["url"]): r["text"] for r in main_text(df).collect()}
    for k, url, page in rows:
        own = [html.unescape(x) for x in re.findall(r"<h2>(.*?)</h2><p>(.*?)</p>", page)[0]]
        assert got[k, url] == " ".join([*own, *(["A passage that many quote, here and there."] if k % 3 == 0 else [])])
    for k in range(20):
        assert got[100 + k, f"http://two.example/{k}"] == f"N {k} text {k}" + (" A passage." if k % 3 == 0 else "")
    assert all(got[200 + k, f"http://copies.example/{k}"] == "One text under many addresses" for k in range(30))
    assert (got[300, None], got[301, "relative/path"], got[302, "http://one.example.org/x"], got[303, "http://one.example.org/y"], got[None, "http://small.example/1"]) == ("no host", "no host", "", "", "alone")
    out = main_text(df)
    assert out.count() == df.count() and main_text(df.limit(0)).count() == 0
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_given_pages_equal_the_standard_parser(spark):
    from lexforge.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    want = {(r["page_id"], r["url"]): twin(r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {(r["page_id"], r["url"]): r["text"] for r in QUERIES["op13_html_text"](spark, sf).collect()}
    assert got == want


def test_hosts(spark):
    urls = ["HTTPS://A.b/c", "http://u:p@h.x:8080/", "ftp://h?x", "//h/x", "mailto:a@b", "", None, "http:///x", "http://[::1]:8/x"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "k int, url string")
    assert [r["h"] for r in df.select("k", html_text.host_of(df["url"]).alias("h")).orderBy("k").collect()] == ["a.b", "h.x", "h", None, None, None, None, None, "[::1]"]
