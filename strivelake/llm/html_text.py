"""Operator 10: main-text extraction by tag-path ratios.

A page becomes a sequence of blocks (runs of inline text inside one block element), each with
its root-to-leaf tag path. For every path the text length and the punctuation of its blocks
are aggregated; text per block times punctuation per block is the path's ratio - high for the
path of paragraphs, low for menus and labels. Ratios are smoothed over neighbouring blocks,
fused with the block's own ratio, and paths above a share of the page's text-weighted mean
are content. A page with an ``article`` or ``main`` element names its article: that is the
smallest such element around the content. On any other page the ratios choose: from the root,
the walk goes down into the child of the highest ratio for as long as the other children stay
under a share of it (a title, a menu, comments of a line or two), so plain ``div``s without a
class are told apart. Headings, short paragraphs and list items of the article come with it:
the threshold decides where the article is, not which of its sentences are long enough.
Elements that are never article text (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, hidden parts, reader comments) are recognised by tag, role, class
or id and left out everywhere.

Each page is parsed alone in an Arrow-batched map; nothing is shuffled.

Defined results: null, empty or text-free pages give an empty text; unclosed and stray tags
follow the usual implied end tags; a cut-off page is read to its last character; repeated
rows give the same text each; extra columns are ignored.
"""
from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strivelake.llm.common import python_batches

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "label", "mark", "output", "picture", "q", "rp", "rt",
          "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr", "img"}
SILENT = {"script", "style", "noscript", "template", "head", "title", "iframe", "svg", "canvas",
          "object", "audio", "video", "select", "textarea", "button", "form", "nav", "footer",
          "aside", "dialog", "menu", "fieldset", "math", "map"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
         "alertdialog", "menu", "menubar", "toolbar", "alert", "note"}
NAMES = {"nav", "navbar", "navigation", "menu", "menubar", "sidebar", "aside", "footer", "masthead",
         "topbar", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent", "gdpr", "notice",
         "notices", "notification", "alert", "banner", "popup", "modal", "overlay", "newsletter",
         "subscribe", "subscription", "promo", "promotion", "sponsor", "sponsored", "sponsors",
         "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adbox",
         "adsense", "adslot", "adsbygoogle", "adunit", "adcontainer", "adwrap", "social", "share", "sharing", "related", "recommended", "comment",
         "comments", "commentlist", "disqus", "respond", "reply", "replies", "login", "signup",
         "search", "searchbox", "pagination", "pager", "widget", "widgets", "toolbar", "hidden",
         "outbrain", "taboola", "tags", "skip", "copyright", "legal", "disclaimer"}
HEADERS = {"header", "masthead", "hero"}
# A header with one of these names, or inside an article, is the article's: its headings stay.
OWN_HEADERS = {"article", "entry", "post", "story", "content", "page"}
ASIDE_ARTICLES = {"comment", "comments", "reply", "ad", "ads", "advert", "advertisement", "promo",
                  "sponsored", "related", "teaser"}
# Layout classes such as has-sidebar speak of another element.
LAYOUT = {"has", "with", "no", "without"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CORE = {"html", "body", "main", "article"}
# A start tag closes these open elements up to the given limits.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")
SPACE = re.compile(r"\s+")
KEEP_SHARE = 0.2       # of the text-weighted mean ratio
SAME_SHARE = 0.4       # of the best sibling's ratio: an element above it is a part of the article too
PARAGRAPHS = {"p", "blockquote", "pre"}
LINK_SHARE = 0.75      # blocks with more link text and no sentence are menus


class _Element:
    __slots__ = ("tag", "path", "parent", "silent", "heading_only", "depth")

    def __init__(self, tag: str, parent: _Element | None, silent: bool, heading_only: bool):
        self.tag, self.parent, self.silent, self.heading_only = tag, parent, silent, heading_only
        self.path = f"{parent.path}/{tag}" if parent else tag
        self.depth = parent.depth + 1 if parent else 0


class _Block:
    __slots__ = ("element", "parts", "link_chars", "heading", "text")

    def __init__(self, element: _Element):
        self.element, self.parts, self.link_chars, self.heading, self.text = element, [], 0, False, ""


def _names(attrs: list[tuple[str, str | None]]) -> set[str]:
    found = set()
    for value in " ".join(v or "" for k, v in attrs if k in ("class", "id")).split():
        parts = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]
        if parts and parts[0] not in LAYOUT:
            found.update(parts)
    return found


class _Page(HTMLParser):
    """Blocks of a page in order, without the silent elements."""

    def __init__(self, silent_tags: set[str] = SILENT) -> None:
        super().__init__(convert_charrefs=True)
        self.silent_tags = silent_tags
        self.top = _Element("", None, False, False)
        self.open = [self.top]
        self.blocks: list[_Block] = []
        self.block: _Block | None = None
        self.links = 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self._imply_end(*CLOSES[tag])
        if tag not in INLINE and tag not in VOID:
            self._imply_end({"p"}, {"article", "section", "div", "td", "li", "blockquote", "body"})
            self.block = None
        if tag in VOID:
            if tag == "br" and self.block:
                self.block.parts.append(" ")
            elif tag == "hr":
                self.block = None
            return
        parent = self.open[-1]
        values = dict(attrs)
        names = _names(attrs)
        in_article = any(e.tag in ("article", "main") for e in self.open)
        heading_only = parent.heading_only
        silent = parent.silent or tag in self.silent_tags
        if not silent and tag not in CORE:
            style = re.sub(r"\s", "", values.get("style") or "").lower()
            silent = (bool(names & NAMES) or (values.get("role") or "").lower() in ROLES
                      or "hidden" in values or (values.get("aria-hidden") or "") == "true"
                      or "display:none" in style or "visibility:hidden" in style)
            if not silent and (tag == "header" or names & HEADERS):
                silent, heading_only = not (in_article or names & OWN_HEADERS), True
        elif not silent and tag == "article" and names & ASIDE_ARTICLES:
            silent = True
        self.open.append(_Element(tag, parent, silent, heading_only))
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "use", "circle", "rect"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br" and self.block:
            self.block.parts.append(" ")
        if tag not in INLINE:
            self.block = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self._close(k)
                return
            if tag in INLINE and self.open[k].tag in ("article", "section", "div", "td", "body"):
                return  # a stray inline end does not close the boxes around it

    def _imply_end(self, closed: set[str], limits: set[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in closed:
                self._close(k)
                if closed == {"p"}:
                    return
            elif tag in limits or (tag not in INLINE and closed == {"p"}):
                return

    def _close(self, k: int) -> None:
        self.links -= sum(e.tag == "a" for e in self.open[k:])
        del self.open[k:]
        self.block = None if self.open[-1].tag not in INLINE and k < len(self.open) else self.block

    def handle_data(self, data):
        element = self.open[-1]
        if element.silent or not data:
            return
        if not self.block:
            if not data.strip():
                return
            box = element
            while box.tag in INLINE and box.parent:
                box = box.parent
            self.block = _Block(box)
            self.blocks.append(self.block)
        self.block.parts.append(data)
        if self.links:
            self.block.link_chars += len(data.strip())
        if any(e.tag in HEADINGS for e in self.open[-3:]):
            self.block.heading = True


def _ratios(blocks: list[_Block]) -> list[float]:
    """Smoothed, fused tag-path ratio of every block."""
    by_path: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    own = []
    for b in blocks:
        marks = len(PUNCTUATION.findall(b.text))
        sums = by_path[b.element.path]
        sums[0] += len(b.text) - b.link_chars if len(b.text) > b.link_chars else 0
        sums[1] += marks
        sums[2] += 1
        own.append(math.log1p(max(len(b.text) - b.link_chars, 0) * (1 + marks)))
    path = []
    for b in blocks:
        length, marks, n = by_path[b.element.path]
        path.append(math.log1p(length / n * (1 + marks / n)))
    last = len(blocks) - 1
    smooth = [0.25 * path[max(k - 1, 0)] + 0.5 * path[k] + 0.25 * path[min(k + 1, last)]
              for k in range(len(blocks))]
    return [0.5 * path[k] + 0.25 * smooth[k] + 0.25 * own[k] for k in range(len(blocks))]


def _around(blocks: list[_Block]) -> _Element:
    """The smallest element that holds all blocks, widened to its article or main element."""
    box = blocks[0].element
    for b in blocks[1:]:
        other = b.element
        while box is not other:
            if box.depth >= other.depth and box.parent:
                box = box.parent
            else:
                other = other.parent
    wide = box
    while wide.parent:
        if wide.tag in ("article", "main"):
            return wide
        wide = wide.parent
    if box.parent and box.tag not in ("body", "html", "section", "div"):
        box = box.parent
    return box


def _by_ratio(content: list[tuple[_Block, float]]) -> tuple[_Element, set[int], bool]:
    """The element that the ratios choose, the ids of its children that are content, and whether
    other boxes among its children are left out; ``content``: blocks and their ratios."""
    weight: dict[int, float] = defaultdict(float)
    chars: dict[int, int] = defaultdict(int)
    kids: dict[int, dict[int, _Element]] = defaultdict(dict)
    for b, r in content:
        e = b.element
        while e:
            weight[id(e)] += len(b.text) * math.expm1(r)
            chars[id(e)] += len(b.text)
            if e.parent:
                kids[id(e.parent)][id(e)] = e
            e = e.parent
    box = content[0][0].element
    while box.parent:
        box = box.parent
    while True:
        below = kids[id(box)]
        ratio = {k: weight[k] / chars[k] for k in below}
        inner = [k for k in below if kids[k]]
        own = any(e.tag in PARAGRAPHS and not kids[k] for k, e in below.items())
        if not below or (own and box.tag not in ("", "html", "body")):
            return box, set(below), False
        best = max(inner or below, key=lambda k: (weight[k], ratio[k]))
        bar = SAME_SHARE * ratio[best]
        alike = {k for k in below if ratio[k] >= bar}
        if len(alike) > 1 or (len(below) > 1 and best not in inner):
            return box, alike if best in inner else set(below), best in inner
        box = below[best]


def _chosen(blocks: list[_Block], content: list[tuple[_Block, float]]) -> list[_Block]:
    """The blocks of the article that the ratios choose, its title included."""
    box, alike, split = _by_ratio(content)
    if box.parent and box.tag not in ("body", "html", "section", "div"):
        box, split = box.parent, False
    out = []
    for b in blocks:
        e, child = b.element, None
        while e is not box and e.parent:
            e, child = e.parent, e
        if e is box and not (split and child and id(child) not in alike and child.tag not in HEADINGS):
            out.append(b)
    if out and not any(b.element.tag == "h1" for b in out):  # the title may stand in a box of its own
        titles = [b for b in blocks[:blocks.index(out[0])] if b.element.tag == "h1"]
        out = titles[-1:] + out
    return out


def _within(e: _Element, box: _Element) -> bool:
    while e is not box and e.parent:
        e = e.parent
    return e is box


def _blocks(html: str, silent_tags: set[str]) -> list[_Block]:
    page = _Page(silent_tags)
    page.feed(html)
    page.close()
    for b in page.blocks:
        b.text = SPACE.sub(" ", "".join(b.parts)).strip()
    return [b for b in page.blocks if b.text and (b.heading or not b.element.heading_only)]


def extract_text(html: str | None) -> str:
    """The article text of a page: blocks joined by a blank line."""
    blocks = _blocks(html or "", SILENT)
    if not blocks:
        blocks = _blocks(html or "", SILENT - {"form"})
        if not any(b.heading for b in blocks):  # else a form around the whole page
            return ""
    ratios = _ratios(blocks)
    weight = sum(len(b.text) for b in blocks)
    bar = KEEP_SHARE * sum(r * len(b.text) for r, b in zip(ratios, blocks)) / weight

    def menu_like(b: _Block) -> bool:
        return b.link_chars > LINK_SHARE * len(b.text) and not re.search(r"[.!?]", b.text)

    framed = {id(b) for b in blocks if re.search(r"(^|/)(article|main)(/|$)", b.element.path)}
    pool = [(b, r) for b, r in zip(blocks, ratios) if not framed or id(b) in framed]
    content = ([x for x in pool if x[1] >= bar and not menu_like(x[0])]
               or [x for x in pool if not menu_like(x[0])] or pool)
    if framed:
        box = _around([b for b, _ in content])
        found = [b for b in blocks if _within(b.element, box)]
    else:
        found = _chosen(blocks, content)
    return "\n\n".join(b.text for b in found if b.heading or not menu_like(b))


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string())],
            names=[*batch.schema.names[:-1], "text"])


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    python_batches(pages.sparkSession, rows=500)
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    kind = dict(slim.dtypes)
    return (slim.mapInArrow(_extract_batches,
                            f"page_id {kind['page_id']}, url {kind['url']}, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
