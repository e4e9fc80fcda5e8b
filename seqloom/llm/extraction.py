"""Main text of web pages by text-to-tag ratios over the events of the standard library's streaming parser.

Parser events cut a page into lines: the text between two block boundaries, with the number of tags and of link
characters on it. Elements that are no article by their own markup (menus, footers, asides, forms, scripts, elements
whose class, id or role says advert, comments, cookie notice and the like) count as lines of ratio 0.

1. Ratio: a line's characters outside links for each of its tags.
2. A Gaussian smooths the ratios over neighbouring lines.
3. Threshold clustering: lines whose smoothed ratio reaches one standard deviation of the page's are content.
4. Regions: an unmarked `article` (or `main`) with a content line is a region. Without any, a container (div,
   section, cell, ...) most of whose characters are on content lines is one, if a line of its own reaches the
   threshold before smoothing; so is what stands between two regions of the same parent and is no list of links; a
   heading right before the first region belongs to it. All unmarked lines of a region are kept, long or short.

White space (as Unicode has it, so with no-break spaces) inside a line becomes one space; `br` is white space.

Defined results: a null or empty page, and one without text, give an empty text; markup that is cut off or never closed
is read as far as it goes (an unclosed comment hides the rest); equal pages give equal texts; an empty table gives
an empty result. Pages are read whole, one at a time, in `mapInArrow` over batches cut at about 4 MB.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from seqloom.llm import tokens as T
from seqloom.llm.shipping import map_arrow
from seqloom.llm.store import REST, pack_rest

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(
    "html body div section article main td th center details figure blockquote ul ol dl menu table form header nav "
    "aside footer fieldset dialog search".split()
)
BLOCKS = CONTAINERS | frozenset(
    "address caption dd dt figcaption h1 h2 h3 h4 h5 h6 hgroup hr legend li optgroup option p pre summary "
    "tbody tfoot thead tr title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl menu table".split())
#: Elements whose text is never read.
UNREAD = frozenset("script style noscript template iframe svg object canvas audio video head select textarea datalist".split())
#: An element closed by the start of one of these, as the standard lets it be left open.
CLOSED_BY = {
    "p": BLOCKS - {"title", "option", "optgroup", "tbody", "thead", "tfoot", "tr", "td", "th", "caption", "legend", "summary"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "head": {"body"},
}
#: Marks of an element: its layout says that it is no article, or its kind does, whatever it holds.
LAYOUT, KIND = 1, 2
TAG_MARKS = {"nav": KIND, "aside": KIND, "footer": KIND, "menu": KIND, "form": LAYOUT, "button": KIND, "dialog": LAYOUT, "search": KIND}
ROLE_MARKS = {
    "navigation": KIND, "banner": LAYOUT, "contentinfo": KIND, "complementary": KIND, "search": KIND, "form": LAYOUT,
    "dialog": LAYOUT, "alertdialog": LAYOUT, "alert": LAYOUT, "menu": KIND, "menubar": KIND, "toolbar": KIND, "tablist": KIND,
}
#: Words of class and id names.
KIND_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored sponsors promo promos promoted "
    "promotion comment comments commentlist commentary disqus reply replies respond responses discussion feedback related "
    "recommended recommendations nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager share sharing social "
    "footer copyright newsletter subscribe subscription signup login tags".split()
)
LAYOUT_WORDS = frozenset(
    "sidebar sidebars aside widget widgets masthead topbar banner cookie cookies consent gdpr notice notices notification alert "
    "popup modal overlay lightbox toast toolbar search form hidden skip disclaimer legal".split()
)
BODY_WORDS = frozenset("article post entry story content main body text".split())
_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: A heading that opens the readers' part of a page (fixed words of the pages' languages).
_READERS = re.compile(
    r"(\d+\s+)?((reader|user|latest|recent)\s+)?(comments?|replies|responses|kommentare|commentaires|comentarios)(\s*\(?\d+\)?)?:?"
    r"|leave\s+a\s+(comment|reply)|post\s+a\s+comment|join\s+the\s+discussion",
    re.I,
)
#: Gaussian over a line and two neighbours on each side.
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
LINKS = 0.5


def mark_of(tag: str, attributes: list[tuple[str, str | None]]) -> int:
    """Whether an element's own markup says that it is no part of an article."""
    mark = TAG_MARKS.get(tag, 0)
    names = ""
    for name, value in attributes:
        if name in ("class", "id"):
            names += f" {value or ''}"
        elif name == "role":
            mark = max(mark, ROLE_MARKS.get((value or "").strip().lower(), 0))
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _GONE.search(value or "")):
            mark = max(mark, LAYOUT)
    if names and tag not in ("html", "body", "main"):
        words = {w.lower() for w in _NAME.findall(names)}
        if words & KIND_WORDS:
            return KIND
        if words & LAYOUT_WORDS or ("header" in words and not words & BODY_WORDS):
            return max(mark, LAYOUT)
    return mark


class Lines(HTMLParser):
    """Collects a page's lines and the tree of elements that they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.mark = [-1], ["html"], [0]
        self.stack, self.unread, self.links = [0], 0, 0
        self.pieces, self.link_chars, self.tags = [], 0, 0
        self.lines: list[tuple[str, int, int, int]] = []  # text, characters in links, tags, element

    def line_ends(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.lines.append((text, min(self.link_chars, len(text)), self.tags, self.stack[-1]))
            self.pieces = []
        self.link_chars = self.tags = 0

    def _pop(self) -> None:
        tag = self.tag[self.stack.pop()]
        self.unread -= tag in UNREAD

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block:
            self.line_ends()
            for closed in ("p", "li", "dt", "dd", "option", "tr", "td", "th", "head"):
                if tag in CLOSED_BY[closed]:
                    self._leave(closed, implied=True)
        self.tags += 1
        if tag == "a":
            self.links = 1
        elif tag == "br":
            self.pieces.append(" ")
        if tag in VOID:
            return
        mark = mark_of(tag, attrs)
        if block or mark or tag in UNREAD:
            above = self.mark[self.stack[-1]]
            if tag == "header" and not above and not mark and not self._inside(("article", "main")):
                mark = LAYOUT
            if (tag == "main" or (tag == "article" and above != KIND)) and mark != KIND:
                above = 0  # a wrapper's layout name does not speak for the article in it
            self.parent.append(self.stack[-1])
            self.tag.append(tag)
            self.mark.append(max(mark, above))
            self.stack.append(len(self.tag) - 1)
            self.unread += tag in UNREAD

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in UNREAD:
            self._leave(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.links = 0
        if tag in BLOCKS:
            if tag == "hr":
                return
            self.line_ends()
        self._leave(tag)

    def _inside(self, tags) -> bool:
        return any(self.tag[e] in tags for e in self.stack)

    def _leave(self, tag: str, implied: bool = False) -> None:
        """Close the innermost open element of that name; one closed by implication lies in no other container."""
        for depth in range(len(self.stack) - 1, 0, -1):
            open_tag = self.tag[self.stack[depth]]
            if open_tag == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if implied and open_tag in CONTAINERS and not (tag in ("td", "th", "tr") and open_tag in ("td", "th")):
                return

    def handle_data(self, data):
        if not self.unread:
            self.pieces.append(data)
            if self.links:
                self.link_chars += len(data.strip())

    def parse_html_declaration(self, i):
        rest = self.rawdata
        if rest.startswith("<!--", i):
            end = rest.find("-->", i + 4)
            return len(rest) if end < 0 else end + 3
        end = rest.find(">", i + 2)
        return len(rest) if end < 0 else end + 1


def smoothed(ratios: np.ndarray) -> np.ndarray:
    weight = np.convolve(np.ones(len(ratios)), KERNEL)[2 : 2 + len(ratios)]
    return np.convolve(ratios, KERNEL)[2 : 2 + len(ratios)] / weight


def content_lines(lines: list[tuple[str, int, int, int]], marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unmarked lines of the cluster of high smoothed text-to-tag ratios, and those that reach it on their own."""
    ratios = np.where(marked, 0.0, [(len(text) - linked) / max(tags, 1) for text, linked, tags, _ in lines])
    level = smoothed(ratios)
    least = min(float(level.std()), float(level[~marked].max(initial=0.0)))
    return ~marked & (level >= least), ~marked & (ratios >= least)


def main_text(html: str | None) -> str:
    """The blocks of a page's main text, one a line."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.line_ends()
    lines = page.lines
    if not lines:
        return ""
    parent, tag, mark = page.parent, page.tag, page.mark
    marked = np.array([mark[e] > 0 for *_, e in lines])
    _mark_readers(lines, tag, parent, marked)
    content, cores = content_lines(lines, marked)
    kept = _articles(lines, tag, parent, marked, content)
    if kept is None:
        kept = _regions(lines, tag, parent, marked, content, cores)
    return "\n".join(line[0] for line, keep in zip(lines, kept, strict=True) if keep)


def _mark_readers(lines, tag, parent, marked) -> None:
    """After a heading that opens the readers' part, the rest of its container is theirs."""
    for i, (text, *_, element) in enumerate(lines):
        if tag[element] in HEADINGS and not marked[i] and len(text) < 60 and _READERS.fullmatch(text):
            top = parent[element]
            for j in range(i, len(lines)):
                e = lines[j][3]
                while e > top:
                    e = parent[e]
                if e != top:
                    break
                marked[j] = True


def _articles(lines, tag, parent, marked, content):
    """Unmarked lines of the articles (or else of `main`) with content, and of headings of `main`; None without any."""
    inside, headline = [], []
    for *_, e in lines:
        article, main, heading = -1, -1, tag[e] in HEADINGS
        while e >= 0:
            if tag[e] == "article":
                article = e  # the outermost
            elif tag[e] == "main":
                main = e
            e = parent[e]
        inside.append((article, main))
        headline.append(heading and main >= 0)
    for kind in (0, 1):
        chosen = {where[kind] for where, yes in zip(inside, content, strict=True) if yes and where[kind] >= 0}
        if not chosen:
            continue
        of = np.array([where[kind] in chosen for where in inside])
        first = int(np.argmax(of & ~marked))
        lead = np.array([headline[i] and i < first for i in range(len(lines))])
        return ~marked & (of | lead)
    return None


def _regions(lines, tag, parent, marked, content, cores):
    """Unmarked lines of the containers whose text is mostly on content lines, and of what stands between them."""
    links: dict[int, list[int]] = {}
    for text, linked, _, e in lines:
        while e > 0:
            if tag[e] in LISTS:
                sums = links.setdefault(e, [0, 0])
                sums[0] += linked
                sums[1] += len(text)
            e = parent[e]

    def container(e: int) -> int:
        while e > 0 and (tag[e] not in CONTAINERS or (tag[e] in LISTS and links[e][0] <= LINKS * links[e][1])):
            e = parent[e]
        return e

    of = [container(e) for *_, e in lines]
    sums: dict[int, list[int]] = {}
    for (text, *_), c, yes, no in zip(lines, of, content, marked, strict=True):
        if not no:
            share = sums.setdefault(c, [0, 0])
            share[0] += len(text) * bool(yes)
            share[1] += len(text)
    high = {c for c, core in zip(of, cores, strict=True) if core}  # not only by what its neighbours lend it
    good = {c for c, (yes, whole) in sums.items() if 2 * yes >= whole and c in high and tag[c] not in LISTS}
    if not good:
        return content
    kept = np.array([c in good and not no for c, no in zip(of, marked, strict=True)])
    spans: dict[int, list[int]] = {}  # of each parent: the first and last kept line in it
    for i in np.flatnonzero(kept).tolist():
        c = parent[of[i]]
        span = spans.setdefault(c, [i, i])
        span[1] = i
    for i, (text, linked, _, e) in enumerate(lines):
        if not kept[i] and not marked[i] and linked <= LINKS * len(text):
            for span in filter(None, (spans.get(of[i]), spans.get(parent[of[i]]))):
                kept[i] |= span[0] < i < span[1] or (tag[e] in HEADINGS and i == span[0] - 1)
    return kept


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """(__rest, _text, _n_blocks) for every row of `pages`; `__rest` is a struct of its other columns."""
    packed = pack_rest(pages, column)
    schema = StructType([
        next(f for f in packed.schema.fields if f.name == REST),
        StructField("_text", StringType()), StructField("_n_blocks", LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.blocks(batch, column):
                made = [main_text(html) for html in part.column(column).to_pylist()]
                blocks = [text.count("\n") + 1 if text else 0 for text in made]
                yield pa.RecordBatch.from_arrays(
                    [part.column(REST), pa.array(made, pa.string()), pa.array(blocks, pa.int64())], schema.names
                )

    return map_arrow(packed, run, schema)
