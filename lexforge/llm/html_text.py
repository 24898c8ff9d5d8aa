"""Main text of web pages: site templates are removed by what recurs among the pages of a host.

Elements that declare what they are (navigation, footers, adverts, forms, comments, ...) go on every page.  Of what is
left, the subtrees of block elements are hashed and counted per host in Spark, and subtrees that recur across many pages
of their host are deleted.  Text outside of a page's article goes where the page marks one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from lexforge.llm.staging import staged
from lexforge.llm.texts import map_batches

#: A subtree recurs if so many different pages of its host have it; a template of articles must be on SITE_PAGES and half of the host's.
MANY_PAGES, SITE_PAGES = 3, 10
#: Elements nested deeper are blocks, and no subtrees of their own.
DEPTH = 512

# fixed values of the HTML standard and of WAI-ARIA
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset(
    "head script style noscript template nav aside form fieldset button input select textarea label dialog iframe object embed applet svg math canvas audio video map menu title datalist output progress meter noembed noframes "
    "frameset xmp footer".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist tooltip status".split())
#: An open element of these is closed by the start of one of those.
CLOSES = {
    "head": BLOCK - {"html"}, "p": BLOCK - set("html body caption optgroup option tbody td tfoot th thead tr".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "caption": {"tr", "td", "th", "tbody", "thead", "tfoot"},
}
CLOSED_BY = {name: frozenset(k for k, v in CLOSES.items() if name in v) for name in BLOCK}
#: Words of class names and ids by which elements declare themselves no part of an article (our own list), and those that speak of an article.
DECLARED = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent dialog disqus footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related replies respond share sharing sidebar signup social sponsor sponsored sponsors subscribe subscription toolbar topbar".split()
)
NO_ARTICLE = frozenset("ad advert advertisement comment comments promo related reply sponsored".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'=<>`]++)))?+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_TREES = "array<struct<tree:bigint,path:bigint,inside:boolean>>"
_BLOCKS = "array<struct<text:string,within:array<bigint>>>"


def _hash(x: str) -> int:
    return xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) >> 1


class _Element:
    """An open element: ``n`` tells it from all others, 0 where it is no block; ``said`` is what its subtree's hash is made of."""

    __slots__ = ("chars", "gone", "linked", "n", "name", "path", "said", "soft")

    def __init__(self, name: str, n: int, path: int, gone: bool = False, soft: bool = False):
        self.name, self.n, self.path, self.gone, self.soft = name, n, path, gone, soft
        self.said: list[str] = []
        self.chars = self.linked = 0


class _Page:
    """One pass over a page's tags, with the implied end tags of the HTML standard."""

    def __init__(self) -> None:
        self.stack = [_Element("", 0, 0)]
        self.run: list[str] = []
        #: (text, numbers of the block elements around it, 2 in an article, 1 in main, 0 outside)
        self.blocks: list[tuple[str, tuple[int, ...], int]] = []
        #: element: (hash, hash of its place, whether inside an article or main)
        self.trees: dict[int, tuple[int, int, bool]] = {}
        #: Open elements beyond DEPTH, by name.
        self.deep: dict[str, int] = {}
        self.soft: set[int] = set()
        self.around_articles: set[int] = set()
        self.menus: set[int] = set()
        self.n = self.gone = self.article = self.main = self.link = 0

    def read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            token = _TOKEN.search(html, at)
            if not token:
                self.text(html[at:])
                break
            self.text(html[at : token.start()])
            at = token.end()
            if not token[2]:
                continue
            name = token[2].lower()
            if token[1]:
                self.end(name)
                continue
            self.start(name, token[3])
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                at = (html.find(">", stop.end()) + 1 or end) if stop else end
        while len(self.stack) > 1:
            self.close()
        self.end_block()

    def text(self, raw: str) -> None:
        if raw and not self.gone:
            said = unescape(raw) if "&" in raw else raw
            self.run.append(said)
            n = len(said) - said.count(" ") - said.count("\n")
            self.stack[-1].chars += n
            if self.link:
                self.stack[-1].linked += n

    def end_block(self) -> None:
        """What was read since the last boundary becomes a block of the open element."""
        if self.run and not self.gone:
            said = " ".join("".join(self.run).split())
            self.run = []
            if said:
                self.blocks.append((said, tuple(e.n for e in self.stack if e.n), 2 if self.article else 1 if self.main else 0))
                self.stack[-1].said.append(said)

    def start(self, name: str, raw: str) -> None:
        if closed := CLOSED_BY.get(name):
            for k in range(len(self.stack) - 1, 0, -1):
                open_ = self.stack[k].name
                if open_ in closed:
                    while len(self.stack) > k:
                        self.close()
                elif open_ in BLOCK and open_ not in CLOSES:
                    break
        if name in VOID:
            if name == "hr":
                self.end_block()
            elif name == "br" and not self.gone:
                self.run.append(" ")
            return
        if name in RAW or (name in ("html", "body") and any(e.name == name for e in self.stack)):
            return
        if name == "a":
            self.link = 1
        too_deep = len(self.stack) > (2 * DEPTH if self.gone else DEPTH)
        if self.gone:
            if too_deep:
                self.deep[name] = self.deep.get(name, 0) + 1
                return
            self.stack.append(_Element(name, 0, 0, gone=True))
            self.gone += 1
            return
        never, soft, place = _declared(name, raw, self.article > 0)
        if name in BLOCK:
            self.end_block()
        elif not never and not soft:
            return
        if never or (soft and (too_deep or name not in BLOCK)):
            self.stack.append(_Element(name, 0, 0, gone=True))
            self.gone += 1
            return
        if too_deep:
            self.deep[name] = self.deep.get(name, 0) + 1
            return
        self.n += 1
        self.stack.append(_Element(name, self.n, _hash(f"{self.stack[-1].path}/{place}"), soft=soft))
        if soft:
            self.soft.add(self.n)
        if name == "article" and not soft:
            if not self.article:
                self.around_articles.update(e.n for e in self.stack if e.soft)
            self.article += 1
        elif name == "main":
            self.main += 1

    def end(self, name: str) -> None:
        if name == "a":
            self.link = 0
        if self.deep.get(name):
            self.deep[name] -= 1
            if name in BLOCK:
                self.end_block()
            return
        at = next((k for k in range(len(self.stack) - 1, 0, -1) if self.stack[k].name == name), 0)
        # an inline end tag doesn't close the blocks within
        if at and (name in BLOCK or not any(e.name in BLOCK for e in self.stack[at + 1 :])):
            while len(self.stack) > at:
                self.close()
        elif name in BLOCK and not self.gone:
            self.end_block()

    def close(self) -> None:
        element = self.stack[-1]
        if element.gone:
            self.stack.pop()
            self.gone -= 1
            return
        self.end_block()
        self.stack.pop()
        inside = self.article > 0 or self.main > 0
        if element.name == "article" and not element.soft:
            self.article -= 1
        elif element.name == "main":
            self.main -= 1
        outer = self.stack[-1]
        outer.chars += element.chars
        outer.linked += element.linked
        if not element.said:
            return
        tree = _hash("\x00".join([element.name, *element.said]))
        outer.said.append(f"\x01{tree}")
        if element.name not in ("html", "body", "main", "article"):
            self.trees[element.n] = tree, element.path, inside
            if element.name in ("ul", "ol", "dl") and element.chars == element.linked and not inside:
                self.menus.add(element.n)


def _declared(name: str, raw: str, in_article: bool) -> tuple[bool, bool, str]:
    """(no part of any main text, no part unless it holds all articles, name and classes for its place)."""
    if name in NEVER or (name == "header" and not in_article):
        return True, False, name
    if "=" not in raw and "hidden" not in raw:
        return False, False, name
    found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return True, False, name
    if name not in ("html", "body", "main", "article") and ROLES & set(found.get("role", "").lower().split()):
        return True, False, name
    classes = found.get("class", "")
    place = f"{name}.{'.'.join(sorted(c for c in classes.split() if not any(map(str.isdigit, c))))}" if name not in ("html", "body") else name
    words = {w.lower() for w in _WORD.findall(f"{classes} {found.get('id', '')}")}
    if name == "article":
        return False, bool(words & NO_ARTICLE), place
    declared = DECLARED - {"header"} if in_article else DECLARED
    return False, name not in ("html", "body", "main") and bool(words & declared), place


def parse(html: str) -> tuple[list[tuple[str, list[int]]], set[tuple[int, int, bool]]]:
    """The blocks of a page's main text with the subtrees around each, and these subtrees: (hash, hash of the place, in an article or main).

    Declared elements are left out, but for those that hold every article of the page, and so are lists of links outside of
    articles.  Where articles hold text, text outside of them is left out; else the same for main.
    """
    page = _Page()
    page.read(html)
    soft = page.soft
    if page.around_articles and not any(mark and soft.isdisjoint(around) for _, around, mark in page.blocks):
        soft = soft - page.around_articles
    left_out = soft | page.menus
    kept = [(said, around, mark) for said, around, mark in page.blocks if left_out.isdisjoint(around)]
    best = max((mark for _, _, mark in kept), default=0)
    blocks = [(said, [page.trees[n] for n in around if n in page.trees]) for said, around, mark in kept if mark == best]
    return [(said, [tree for tree, _, _ in trees]) for said, trees in blocks], {t for _, trees in blocks for t in trees}


def host_of(url: Column) -> Column:
    """Lower-case host name of a URL, null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))
    return F.when(host != "", host)


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (key, page_id, url, host, content, blocks, trees): ``parse`` of every page, and a hash of its text."""
    rows = pages.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = f"key bigint, page_id {rows.schema['page_id'].dataType.simpleString()}, url string, content bigint, blocks {_BLOCKS}, trees {_TREES}"
    block_type = pa.list_(pa.struct([("text", pa.string()), ("within", pa.list_(pa.int64()))]))
    tree_type = pa.list_(pa.struct([("tree", pa.int64()), ("path", pa.int64()), ("inside", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse(x or "") for x in batch.column(3).to_pylist()]
            content = [_hash("\n".join(said for said, _ in blocks)) for blocks, _ in found]
            blocks = [[{"text": said, "within": trees} for said, trees in blocks] for blocks, _ in found]
            trees = [[{"tree": t, "path": p, "inside": i} for t, p, i in sorted(trees)] for _, trees in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(content, pa.int64()), pa.array(blocks, block_type), pa.array(trees, tree_type)], ["key", "page_id", "url", "content", "blocks", "trees"])

    return map_batches(rows, run, kinds, rows=64).withColumn("host", host_of(F.col("url")))


def site_templates(found: DataFrame, many_pages: int = MANY_PAGES, site_pages: int = SITE_PAGES) -> DataFrame:
    """Subtrees (host, path, inside, tree) that are templates of their host.

    Pages of one host with equal text count once, so that copies of a page are no template.  A subtree recurs if
    ``many_pages`` different pages have it at the same place; it is a template if at least half of what stands at its place
    recurs, or if ``site_pages`` and half of the host's pages have it.  In articles, only the latter counts, for passages
    may be quoted widely.
    """
    each = found.filter(F.col("host").isNotNull()).select("host", "content", F.inline("trees"))
    per_tree = staged(each.groupBy("host", "path", "inside", "tree").agg(F.countDistinct("content").alias("n"), F.count("*").alias("rows")), "trees")
    recurs = F.col("n") >= many_pages
    places = per_tree.groupBy("host", "path", "inside").agg((2 * F.sum(F.when(recurs, F.col("rows")).otherwise(0)) >= F.sum("rows")).alias("templated"))
    hosts = found.groupBy("host").agg(F.countDistinct("content").alias("n_pages"))
    often = per_tree.filter(recurs).join(places, ["host", "path", "inside"]).join(hosts, "host")
    everywhere = (F.col("n") >= site_pages) & (2 * F.col("n") >= F.col("n_pages"))
    return often.filter(everywhere | (F.col("templated") & ~F.col("inside"))).select("host", "path", "inside", "tree")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", many_pages: int = MANY_PAGES, site_pages: int = SITE_PAGES) -> DataFrame:
    """One row for each row of ``pages``: page_id, url, text, n_chars, n_templates (subtrees of its main text that were deleted as templates).

    Character references are decoded, white space in a block becomes one space, and blocks are joined by one.  Null and
    empty pages, and pages of declared elements alone, have an empty text; a null or relative url has no host, and such
    pages lose no templates.  Repeated rows count once as pages of their host and are all returned; other columns are not
    read; an empty table gives none.
    """
    found = staged(parsed(pages, id_col, url_col, html_col), "pages", compression="zstd")
    templates = staged(site_templates(found, many_pages, site_pages), "templates")
    spots = found.filter(F.col("host").isNotNull()).select("key", "host", F.inline("trees"))
    gone = staged(spots.join(templates, ["host", "path", "inside", "tree"], "left_semi").groupBy("key").agg(F.collect_set("tree").alias("gone")), "gone")
    rows = found.drop("trees", "host", "content").join(gone, "key", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<bigint>")))
    left = F.filter("blocks", lambda b: ~F.arrays_overlap(b["within"], F.col("gone")))
    text = F.array_join(F.transform(left, lambda b: b["text"]), " ")
    return rows.select("page_id", "url", text.alias("text"), F.size("gone").cast("long").alias("n_templates")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_templates")
