"""Main text of web pages by text-to-tag ratio.

The standard library's parser reads a page as a stream of events.  Each block of text between
block-level tags is a line; its ratio is the number of its characters to the number of tags in
and before it.  The ratios are smoothed by a Gaussian, so that a short paragraph among long ones
counts with them, and clustered by a threshold: lines above it are content.  Content lines vote,
by their length, for the elements they stand in.  The region is all articles with content if they
hold nearly all of it, else main elements that do; failing both, main elements, then articles, of
which the largest holds as much as all that is outside of them; else the smallest element that
holds nearly all.  Of the region every line is kept, whatever its own ratio: nothing is capped.
Parts that are no text of the page, by element, role, or the words of class and id (menus,
headers, footers, sidebars, notices, adverts, forms, comments), are left out before; headings in
the header of an article stay, and headings with such a class or id of their own.  The words of class and id do not count for an element that holds
most of the page's text, nor where all text is in elements so named.

A line has its white space turned into single spaces; lines are joined by line feeds.  A line
break within a block is white space.  A tag or comment that the end of the page cuts off is no
text.  NULL, empty and text-free pages give an empty text.
"""

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
NO_TEXT = frozenset(
    "head script style noscript template title iframe object svg math canvas audio video map nav footer aside form "
    "button select textarea input dialog menu datalist fieldset search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# A start tag of the key ends an open element of these within the same container.
IMPLIED_END = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
CONTAINERS = frozenset(
    "html body article main section div table ul ol dl blockquote figure aside nav header footer form details fieldset".split()
)
# Words of class and id that name what is not the article, and such roles.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies "
    "consent gdpr notice notices alert sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead topbar comment comments commentlist replies respond disqus share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup popup modal overlay widget widgets toolbar pagination "
    "pager copyright login searchform skip".split()
)
HEADER_NAMES = frozenset(["header"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

SIGMA = 1.0  # of the Gaussian, in lines
RADIUS = 2  # lines on each side
THRESHOLD = 0.5  # of the mean smoothed ratio
NEARLY_ALL = 0.9
_WEIGHTS = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
_TAG_BEGINS = re.compile("<[A-Za-z/!]")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Element:
    __slots__ = ("tag", "parent", "skipped", "header", "article", "aside", "named", "chars", "votes")

    def __init__(self, tag: str, parent: "_Element | None", skipped: bool, header: bool, named: bool = False):
        self.tag, self.parent, self.skipped, self.header, self.votes = tag, parent, skipped, header, 0.0
        self.aside, self.chars = False, 0  # an article or main with such a name; characters, of named elements
        self.named = self if named else parent.named if parent is not None else None  # the nearest with such a name
        self.article = tag in ("article", "main") or parent is not None and parent.article


class Blocks(HTMLParser):
    """Collects (text, tags, element) of each line in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = _Element("", None, False, False)
        self.at = self.top
        self.lines: list[tuple[str, int, _Element]] = []
        self.parts: list[str] = []
        self.tags = 0

    def read(self, html: str) -> list[tuple[str, int, _Element]]:
        self.feed(_finished(html))
        self.close()
        self.end_line()
        return self.lines

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts.clear()
            if text:
                self.lines.append((text, self.tags, self.at))
                self.tags = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append("\n")
            return
        if tag not in BLOCK and tag not in NO_TEXT:
            if tag not in VOID and attrs and not self.at.skipped:
                skipped, named = _left_out(tag, attrs), _named(tag, attrs)
                if skipped or named:
                    self.open(tag, skipped, False, named)
            return
        self.end_line()
        if tag in VOID:
            return
        self.imply_ends(tag)
        header = tag == "header" or _names(attrs) & HEADER_NAMES != frozenset()
        skipped = tag in NO_TEXT or _left_out(tag, attrs)
        self.open(tag, skipped, header and tag not in HEADINGS, _named(tag, attrs))
        self.at.aside = tag in ("article", "main") and not NAMES.isdisjoint(_names(attrs))

    def open(self, tag: str, skipped: bool, header: bool, named: bool) -> None:
        self.end_line()
        at = self.at
        self.at = _Element(tag, at, at.skipped or skipped, at.header or header, named)

    def imply_ends(self, tag: str) -> None:
        """Closes what a block-level start tag ends: paragraphs, items, cells."""
        ended = IMPLIED_END.get(tag, {"p"})
        node = self.at
        while node is not None and (node.tag in ended or node.tag in HEADINGS and tag in HEADINGS):
            self.at = node = node.parent

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in BLOCK and tag not in NO_TEXT and tag != self.at.tag:
            return
        node = self.at
        while node is not None and node.tag != tag:
            if node.tag in CONTAINERS and tag not in CONTAINERS and tag not in NO_TEXT:
                return  # a stray end tag does not end what it stands in
            node = node.parent
        if node is not None and node.parent is not None:
            self.end_line()
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        if not self.at.skipped:
            self.parts.append(data)


def _finished(html: str) -> str:
    """The page up to a comment or tag that its end cuts off, in time linear in the page."""
    comment = html.find("<!--", max(html.rfind("-->") - 3, 0))
    if comment >= 0:
        return html[:comment]
    tag = html.rfind("<")
    if tag >= 0 and html.find(">", tag) < 0 and _TAG_BEGINS.match(html, tag):
        return html[:tag]
    return html


def _names(attrs) -> frozenset[str]:
    words = [w.lower() for k, v in attrs if k in ("class", "id") and v for w in _NAME_PARTS.findall(v)]
    return frozenset(words)


def _left_out(tag: str, attrs) -> bool:
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    values = dict(attrs)
    if "hidden" in values or values.get("aria-hidden") == "true" or (values.get("role") or "").lower() in ROLES:
        return True
    return "display:none" in (values.get("style") or "").replace(" ", "").lower()


def _named(tag: str, attrs) -> bool:
    """Whether class or id name what is not the article.  A heading's only name its section."""
    if not attrs or tag in ("html", "body", "article", "main") or tag in HEADINGS:
        return False
    return not NAMES.isdisjoint(_names(attrs))


def _text_lines(lines: list[tuple[str, int, _Element]]) -> list[tuple[str, int, _Element]]:
    """Lines outside of named elements; those that hold most of the text do not count as named."""
    whole = 0
    for text, _, element in lines:
        if _shown(element):
            whole += len(text)
            for node in _named_path(element):
                node.chars += len(text)
    kept, tags = [], 0
    for text, n, element in lines:
        if all(2 * node.chars > whole for node in _named_path(element)):
            kept.append((text, tags + n, element))
            tags = 0
        else:
            tags += n
    kept = [x for x in kept if _shown(x[2])]
    return kept or [x for x in lines if _shown(x[2])]


def _named_path(element: _Element | None):
    while element is not None and element.named is not None:
        yield element.named
        element = element.named.parent


def _smoothed(ratios: list[float]) -> list[float]:
    out = []
    for i in range(len(ratios)):
        weight = total = 0.0
        for k, w in enumerate(_WEIGHTS, start=i - RADIUS):
            if 0 <= k < len(ratios):
                weight += w
                total += w * ratios[k]
        out.append(total / weight)
    return out


def _shown(element: _Element) -> bool:
    """Whether a line in a header is a heading of an article."""
    return not element.header or element.article and element.tag in HEADINGS


def main_text(html: str | None) -> str:
    """The article of a page."""
    lines = _text_lines(Blocks().read(html or ""))
    if not lines:
        return ""
    smooth = _smoothed([len(text) / max(tags, 1) for text, tags, _ in lines])
    least = THRESHOLD * sum(smooth) / len(smooth)
    children: dict[_Element, set[_Element]] = {}
    whole = 0.0
    for (text, _, element), ratio in zip(lines, smooth):
        if ratio >= least:
            whole += len(text)
            node = element
            while node is not None:
                node.votes += len(text)
                if node.parent is not None:
                    children.setdefault(node.parent, set()).add(node)
                node = node.parent
    region = _region(lines, children, whole)
    return "\n".join(text for text, _, element in lines if any(e in region for e in _path(element)))


def _region(lines, children: dict[_Element, set[_Element]], whole: float) -> set[_Element]:
    """The elements that hold the content."""
    outer: dict[str, set[_Element]] = {"article": set(), "main": set()}
    for _, _, element in lines:
        last = {}
        for node in _path(element):
            if node.tag in outer and node.votes > 0 and not node.aside:
                last[node.tag] = node
        for tag, node in last.items():
            outer[tag].add(node)
    held = {tag: sum(n.votes for n in found) for tag, found in outer.items()}
    for tag in ("article", "main"):
        if outer[tag] and held[tag] >= NEARLY_ALL * whole:
            return outer[tag]
    for tag in ("main", "article"):
        if outer[tag] and max(n.votes for n in outer[tag]) >= whole - held[tag]:
            return outer[tag]
    at = next(e for e in _path(lines[0][2]) if e.parent is None)
    while True:
        inner = [c for c in children.get(at, ()) if c.tag in CONTAINERS and c.votes >= NEARLY_ALL * whole]
        if not inner:
            return {at}
        at = inner[0]


def _path(element: _Element | None):
    while element is not None:
        yield element
        element = element.parent


@F.pandas_udf(StringType())
def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(page) for page in pages], dtype=object)


def extract(html: Column) -> Column:
    """Main text of a column of pages."""
    return _extract(F.coalesce(html, F.lit("")))
