"""Main text of web pages, with site templates removed.

Pages are parsed once into text blocks. Elements that are boilerplate by tag, class, id or
role (menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles)
give none; what holds the page's article, and the article itself, is none of these. The main
text is that of the ``article`` elements, unless they are a small part (cards): then that of
``main``, else the whole page's.

Every other block element that holds main text could be part of a site's template, inside the
article or not, except plain text elements (a paragraph, a heading, a list item) without a class
or id of their own, which are content. A candidate has the hash of its subtree, that of its path
(tags and names from the root), and one of the rest: the main text that it does not hold. Spark
counts per host. A subtree recurs if it stands with ``LEAST_PAGES`` different rests; copies of a
page or article have the same rest and count once. A path is a template's if at least one part
in ``SHARE`` of its different subtrees-and-rests recur, so that a section's menu goes, whatever
its part of a large host, and a box that mostly differs stays. What recurs at such a path is
deleted. A page's block is in the intervals of the elements that hold it, so a page's record
grows with its length, not with its depth.

Defined cases: null html is empty; a page without text has the empty text; unclosed,
crossed and unknown tags are closed as browsers do, a ``<`` that starts no tag is text;
pages without a host count as one host; repeated rows count as one page and get the same
text; any nesting depth and length is handled without recursion, in linear time; extra columns
are ignored."""

from __future__ import annotations

import hashlib
import html as H
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import join_rows, materialise

LEAST_PAGES = 8   # different rests that a recurring subtree is seen with
SHARE = 2         # one part in SHARE of a path's subtrees recurs, where the path is a template's
#: Bits of the filter of pages that lose blocks: at most 65,536 words on every executor.
FILTER_BITS = 1 << 22

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_DROP = {"nav", "header", "footer", "aside", "form", "head", "button", "select", "svg", "menu",
         "dialog", "object", "canvas", "audio", "video", "math"}
_DROP_NAMES = {"ad", "ads", "adsense", "advert", "adverts", "advertisement", "banner", "breadcrumb",
               "breadcrumbs", "comment", "comments", "commentlist", "consent", "contentinfo",
               "cookie", "cookies", "disclaimer", "footer", "header", "masthead", "menu", "modal",
               "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination",
               "popup", "promo", "related", "replies", "respond", "search", "share", "sharing",
               "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
               "widgets", "complementary", "alert"}
#: Names of what readers and other pages add: an article in them is not the page's article.
_ADDED = {"ad", "ads", "comment", "comments", "commentlist", "complementary", "related", "replies",
          "respond", "sidebar", "widget", "widgets"}
#: ``with-sidebar`` tells about a page, not that an element is a sidebar.
_ABOUT = {"has", "hide", "is", "no", "not", "show", "with", "without"}
#: Elements of running text: without a class or id of their own they are content.
_PLAIN = {"blockquote", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "p",
          "pre", "summary", "tr"}
_BLOCK = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div",
          "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr",
          "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
          "thead", "tr", "ul"} | _DROP - {"button", "select", "svg"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"table", "ul", "ol", "dl", "article", "main", "section", "body", "html"}


class _Element:
    __slots__ = ("tag", "names", "drop", "by_name", "zone", "digest", "text", "path", "first")

    def __init__(self, tag: str, names: str, drop: bool, by_name: str, zone: int, path: int, first: int):
        self.tag, self.names, self.drop, self.by_name, self.zone = tag, names, drop, by_name, zone
        self.digest = hashlib.blake2b(f"{tag}|{names}".encode(), digest_size=8)
        self.text, self.path, self.first = 0, path, first


def _short(data: bytes, size: int = 8) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=size).digest(), "little", signed=True)


def _names(attrs: str) -> str:
    """Class, id and role of a tag, lower-cased."""
    if not attrs or "=" not in attrs:
        return ""
    return " ".join((m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs))


def boilerplate_name(names: str) -> str:
    """The name among ``names`` that says boilerplate, or none: a whole name, or the last
    part of one (``cookie-notice``), unless it tells about a page (``with-sidebar``)."""
    for name in names.split():
        parts = re.split(r"[^a-z0-9]+", name.strip("-_"))
        if parts[-1] in _DROP_NAMES and parts[0] not in _ABOUT:
            return parts[-1]
    return ""


def parse_page(page: str) -> tuple[list[str], list[tuple[int, int, int, int, int]]]:
    """(main blocks, template candidates). A candidate is an element that holds the main
    blocks first .. end - 1: (path, mark, rest, first, end) with the hash of its tags and
    classes from the root, that of its subtree and that of the other main blocks. Time and
    space grow with the page, whatever its depth."""
    stack: list[_Element] = [_Element("", "", False, "", 0, 0, 0)]
    open_tags: dict[str, int] = {}
    blocks: list[tuple[int, str]] = []                  # zone, text
    found: list[tuple[int, int, int, int]] = []          # path, mark, first and end among all blocks
    buffer: list[str] = []
    last_end = page.rfind(">")

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                blocks.append((stack[-1].zone, text))

    def write(raw: str) -> None:
        top = stack[-1]
        if not raw or top.drop:
            return
        text = H.unescape(raw)
        buffer.append(text)
        shown = text.strip()
        if shown:
            top.digest.update(b"\x01" + shown.encode("utf-8", "replace"))
            top.text += len(shown)

    def close() -> None:
        e = stack.pop()
        open_tags[e.tag] -= 1
        up = stack[-1]
        if e.drop:
            return
        digest = e.digest.digest()
        up.digest.update(b"\x02" + digest)
        up.text += e.text
        if (e.text and e.tag in _BLOCK and e.tag not in ("html", "body", "article", "main")
                and (e.names or e.tag not in _PLAIN)):
            found.append((e.path, int.from_bytes(digest, "little", signed=True), e.first, len(blocks)))

    def close_to(depth: int) -> None:
        if any(e.tag in _BLOCK for e in stack[depth:]):
            flush()
        while len(stack) > depth:
            close()

    def last_open(tags, stop) -> int:
        """Depth of the innermost open element of ``tags``, 0 if a ``stop`` lies inside it."""
        if any(open_tags.get(t) for t in tags):
            for d in range(len(stack) - 1, 0, -1):
                if stack[d].tag in tags:
                    return d
                if stack[d].tag in stop:
                    break
        return 0

    at = 0
    while at < len(page):
        start = page.find("<", at)
        m = _TOKEN.search(page, start) if start >= 0 and (start < last_end or page.find("<!--", start) >= 0) else None
        if m is None:
            write(page[at:])
            break
        if m.start() > at:
            write(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            depth = last_open((tag,), ())
            if depth:
                close_to(depth)
            continue
        attrs = m[3] or m[6] or ""
        if tag == "br":
            write(" ")
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = page.find(">", end.end()) + 1 if end and end.end() <= last_end else len(page)
            continue
        if tag in _BLOCK:
            flush()
            depth = last_open(("p",), _BLOCK)            # an open paragraph ends here
            if depth:
                close_to(depth)
        if tag in _CLOSES:
            depth = last_open(_CLOSES[tag], _SCOPE)
            if depth:
                close_to(depth)
        if tag in ("td", "th"):
            write(" ")
        if tag in _VOID or attrs.endswith("/") and tag not in _BLOCK:
            continue
        names = _names(attrs)
        up = stack[-1]
        if tag in ("article", "main"):
            # what holds the page's article is no boilerplate, whatever it is called
            if not any(e.tag == "article" or e.by_name in _ADDED or e.tag in _DROP for e in stack if e.drop or e.zone):
                for e in stack:
                    e.drop = False
            by_name = ""
        else:
            by_name = boilerplate_name(names) if tag not in ("html", "body") else ""
        zone = up.zone | (2 if tag == "article" else 1 if tag == "main" else 0)
        path = _short(f"{up.path}|{tag}|{names}".encode())
        stack.append(_Element(tag, names, bool(up.drop or by_name or tag in _DROP), by_name, zone, path, len(blocks)))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    close_to(1)
    size = [sum(len(t) for z, t in blocks if z & kind) for kind in (1, 2)]
    whole = sum(len(t) for _, t in blocks)
    # articles, unless they are a small part of the main element (cards), or of the page
    if size[1] and (2 * sum(len(t) for z, t in blocks if z == 3) >= size[0] if size[0] else 4 * size[1] >= whole):
        wanted = 2
    else:
        wanted = 1 if size[0] else 0
    main, place, sums = [], [0], [0]
    for zone, text in blocks:
        if zone & wanted or not wanted:
            main.append(text)
            sums.append((sums[-1] + _short(text.encode("utf-8", "replace"))) & (1 << 64) - 1)
        place.append(len(main))
    held: dict[tuple[int, int], int] = {}                # (path, mark) -> sum of the blocks it holds
    for path, mark, first, end in found:
        if place[first] < place[end]:
            held[path, mark] = held.get((path, mark), 0) + sums[place[end]] - sums[place[first]]
    return main, [(path, mark, _short(f"{(sums[-1] - held[path, mark]) & (1 << 64) - 1}".encode(), 4), place[first],
                   place[end]) for path, mark, first, end in found if place[first] < place[end]]


_MARK = [("path", pa.int64()), ("mark", pa.int64()), ("rest", pa.int32()), ("first", pa.int32()), ("end", pa.int32())]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        blocks, marks = [], []
        for page in b.column("html").to_pylist():
            got, candidates = parse_page(page or "")
            blocks.append(got)
            marks.append([dict(zip((n for n, _ in _MARK), c)) for c in candidates])
        rest = [c for c in b.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in rest), pa.array(blocks, pa.list_(pa.string())),
             pa.array(marks, pa.list_(pa.struct(_MARK)))], names=[*rest, "blocks", "marks"])


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                  html: str = "html", least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per page row: pid, url, text."""
    rows = pages.select(
        F.col(page_id).alias("pid"), F.col(url).alias("url"),
        F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)),
                   F.lit("")).alias("host"),
        F.xxhash64(F.col(url), F.col(html)).alias("pkey"), F.col(html).alias("html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    parsed = materialise(rows.mapInArrow(
        _parse, f"{kinds}, blocks array<string>, "
        "marks array<struct<path:bigint,mark:bigint,rest:int,first:int,end:int>>"), "pages-parsed")
    template = templates(parsed.select("host", F.inline("marks")), least_pages)
    keys = ["pid", "pkey"]
    drops = materialise(parsed.select(*keys, "host", F.inline("marks")).join(template, ["host", "path", "mark"])
                        .groupBy(*keys).agg(F.collect_set(F.struct("first", "end")).alias("gone")), "pages-drops")
    # pages that lose nothing aren't shuffled: a bit filter of those that do tells most of them
    slot = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    bits = (drops.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")))
    told = (parsed.select("pid", "pkey", "url", "blocks").withColumn("slot", slot)
            .withColumn("word", F.expr("slot div 64")).join(F.broadcast(bits), "word", "left"))
    hit = F.expr("coalesce(shiftrightunsigned(bits, cast(slot % 64 as int)) & 1, 0) = 1")
    other = join_rows(told.where(hit), drops, keys, "left")
    kept = F.expr("filter(blocks, (b, i) -> gone is null or not exists(gone, g -> g.first <= i and i < g.end))")
    both = told.where(~hit).select("pid", "url", "blocks").union(
        other.select("pid", "url", kept.alias("blocks")))
    return both.select("pid", "url", F.array_join("blocks", "\n\n").alias("text"))


def templates(candidates: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, path, mark) of the subtrees that are a host's template, of the candidates (host,
    path, mark, rest) of its pages."""
    # copies leave the same rest and count once
    seen = (candidates.select("host", "path", "mark", "rest").distinct()
            .groupBy("host", "path", "mark").agg(F.count("*").alias("n")))
    recurs = F.col("n") >= least_pages
    paths = (seen.groupBy("host", "path").agg(F.sum("n").alias("all"), F.sum(F.when(recurs, F.col("n"))).alias("some"))
             .where(F.col("some") * SHARE >= F.col("all")).select("host", "path"))
    return seen.where(recurs).select("host", "path", "mark").join(paths, ["host", "path"], "left_semi")
