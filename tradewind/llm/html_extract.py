"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events; blocks become lines with the length of their text
and the number of tags met. The ratio of the two, smoothed with a Gaussian over neighbouring lines,
is high where there is running text and low in menus and lists of links. Lines whose smoothed ratio
reaches the threshold, the standard deviation over the page, cluster into content regions (Weninger, Hsu
and Han, 2010).

Elements that never are content (menus, scripts, adverts, reader comments, told by tag, role, or a whole
word of class or id) give no lines. Words for parts of a layout decide nothing about an element around the
declared article or most of the text. If the page declares its article, the declaration lowers the threshold,
to the deviation over the article's own lines, and bridges gaps: short running lines between its clusters
stay, and those before and after them as far as no more lines of links stand between than the smoothing sees.
Without a dense line nothing of an article is content. Otherwise the clustered lines of the page are the content.

The work is linear in the page: stacks hold the places of open elements by tag, and marks around a line are
a chain of parents.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.names import quoted
from tradewind.llm.worker import travels_with_tasks

travels_with_tasks(__name__)

#: Lines on either side that the smoothing sees, and its width.
RADIUS, SIGMA = 2, 1.0
#: Share of a line's text in links from which on it is a list of links.
LINKS = 0.5
#: Least ratio, about a word a tag, of a line of links within an article.
WORD_A_TAG = 5.0

# Element names of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
NEVER = frozenset(
    "aside audio button canvas dialog footer head iframe input menu nav noscript object script "
    "search select style svg template textarea title video".split()
)
DECLARED = frozenset(("article", "main"))
DECLARING = frozenset((("role", "main"), ("role", "article"), ("itemprop", "articleBody")))
#: Start tags that end an open paragraph, and items that end an open one of their kind.
ENDS_ITSELF = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Classes and ids, as whole words between blanks, of reader comments, of other parts that no article has, and
#: of parts of a layout, which may also name what stands around the article.
COMMENTS = frozenset("comment comments commentlist comment-list disqus disqus_thread replies reply".split())
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox breadcrumb breadcrumbs consent cookie cookies "
    "cookie-banner cookie-consent cookie-notice gdpr newsletter pager pagination promo promotion share sharing "
    "signup sponsor sponsored subscribe subscription".split()
)
LAYOUT = frozenset(
    "banner dialog login menu main-menu modal nav navbar navigation notification notifications overlay popup "
    "sidebar toolbar widget widgets".split()
)
LAYOUT_OUTSIDE = LAYOUT | {"footer", "header", "masthead", "site-footer", "site-header", "topbar"}
_TAG_START = re.compile(r"<[A-Za-z/!?]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def declares(tag: str, attrs: list) -> bool:
    return tag in DECLARED or bool(attrs) and not DECLARING.isdisjoint(attrs)


@dataclass(slots=True)
class Open:
    """An open element: what closing it ends."""

    tag: str
    refused: bool = False
    declared: bool = False
    held: bool = False


class Lines(HTMLParser):
    """Collects (text, tags, text in links, number of the declared region or -1).

    Parts that a class, an id or a form marks are read and held: only the whole page tells whether the mark
    names a part beside the article or the element around it (``free``).

    ``places`` holds the places of open elements, ascending: by tag, of BLOCK elements, of ENDS, which an end
    of a paragraph does not pass, and of LISTS, which an end of an item does not pass.
    """

    BLOCK, ENDS, LISTS = object(), object(), object()

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = []
        self.skipped = self.inside = 0
        self.lines: list[tuple[str, int, int, int]] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.region = -1
        self.marks: list[tuple[bool, int, int]] = []  # Of a layout, region it lies in or -1, mark around it or -1.
        self.mark = -1
        self.held: list[int] = []  # Innermost mark around each line or -1.
        self.places: defaultdict = defaultdict(list)
        self.link: Open | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, max(1, self.tags), self.linked, self.region if self.inside else -1))
            self.held.append(self.mark)
            self.tags = 0
        self.parts, self.linked = [], 0

    def judged(self, tag: str, attrs: list) -> tuple[bool, bool | None]:
        """Whether an element is refused, and if it is held, whether as a part of a layout."""
        if tag in NEVER:
            return True, None
        if tag in ("html", "body") or not self.inside and declares(tag, attrs):
            return False, None
        layout = tag == "form" or tag == "header" and not self.inside
        given = dict(attrs)
        if "hidden" in given or (given.get("aria-hidden") or "").lower() == "true":
            return True, None
        role = (given.get("role") or "").lower()
        if role in ROLES or _HIDDEN.search(given.get("style") or ""):
            return True, None
        names = f"{given.get('class') or ''} {given.get('id') or ''}".lower().split()
        if not COMMENTS.isdisjoint(names):
            return True, None
        if not MARKED.isdisjoint(names):
            return bool(self.inside), False
        layout = layout or not (LAYOUT if self.inside else LAYOUT_OUTSIDE).isdisjoint(names)
        return False, True if layout else None

    def free(self) -> list[tuple[str, int, int, int]]:
        """Lines without the held parts.

        A held element around all declared regions is no part beside the article, nor is one of a layout
        that has most of the text of its region, or of a page that declares none.
        """
        if not self.marks:
            return self.lines
        size: Counter = Counter()
        around = [0] * len(self.marks)
        lines = list(zip(self.lines, self.held, strict=True))
        for (text, _, linked, region), mark in lines:
            size[region] += max(0, len(text) - linked)
            if mark >= 0:
                around[mark] += max(0, len(text) - linked)
        outside = [False] * len(self.marks)  # Whether a mark outside of all regions is on the way up.
        for mark, (_, region, parent) in enumerate(self.marks):
            outside[mark] = region < 0 or parent >= 0 and outside[parent]
        declared = [mark for line, mark in lines if line[3] >= 0]
        around_declared = [False] * len(self.marks)
        if all(mark >= 0 and outside[mark] for mark in declared):
            for mark in declared:
                around_declared[mark] = True
        for mark in range(len(self.marks) - 1, -1, -1):  # Parents have smaller numbers.
            parent = self.marks[mark][2]
            if parent >= 0:
                around[parent] += around[mark]
                around_declared[parent] |= around_declared[mark]
        lifted = [False] * len(self.marks)  # With all marks around it.
        for mark, (layout, region, parent) in enumerate(self.marks):
            free = region < 0 and around_declared[mark] or (
                layout and (region >= 0 or not declared) and 2 * around[mark] > size[region]
            )
            lifted[mark] = free and (parent < 0 or lifted[parent])
        return [line for line, mark in lines if mark < 0 or lifted[mark]]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush_unless_skipped()
            if tag in ENDS_ITSELF:
                self.close_open(ENDS_ITSELF[tag])
            self.close_paragraph()
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        refused, layout = (False, None) if self.skipped else self.judged(tag, attrs)
        declared = not self.skipped and not refused and declares(tag, attrs)
        held = not refused and layout is not None
        if refused or held:
            self.flush()
        if declared:
            if not self.inside:
                self.region += 1
            self.inside += 1
        if held:
            self.marks.append((layout, self.region if self.inside - declared else -1, self.mark))
            self.mark = len(self.marks) - 1
        self.skipped += refused
        element = Open(tag, refused, declared, held)
        if tag == "a":  # A link ends an open one.
            self.link = element if any(name == "href" for name, _ in attrs) else None
        for kind in self.kinds(element):
            self.places[kind].append(len(self.open))
        self.open.append(element)

    def kinds(self, element: Open) -> list:
        """The stacks of places an element is in."""
        tag, found = element.tag, [element.tag]
        if tag in BLOCKS:
            found.append(self.BLOCK)
        if element.refused or tag in BLOCKS or tag == "button":
            found.append(self.ENDS)
        if element.refused or tag in ("ul", "ol", "dl", "table", "menu", "select"):
            found.append(self.LISTS)
        return found

    def last(self, kind: object) -> int:
        """Place of the innermost open element of a kind; -1 without one."""
        found = self.places.get(kind)
        return found[-1] if found else -1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def flush_unless_skipped(self) -> None:
        if not self.skipped:
            self.flush()

    def close_paragraph(self) -> None:
        at = self.last(self.ENDS)
        if at >= 0 and self.open[at].tag == "p":
            self.leave(at)

    def close_open(self, kinds: tuple) -> None:
        at = max(self.last(kind) for kind in kinds)
        if at >= 0 and at >= self.last(self.LISTS):
            self.leave(at)

    def leave(self, at: int) -> None:
        """Close the open elements from this one on."""
        self.flush_unless_skipped()
        while len(self.open) > at:
            element = self.open.pop()
            self.skipped -= element.refused
            self.inside -= element.declared
            if element.held:
                self.mark = self.marks[self.mark][2]
            if element is self.link:
                self.link = None
            for kind in self.kinds(element):
                self.places[kind].pop()

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        at = self.last(tag)
        if at < 0:
            if tag in BLOCKS:
                self.flush_unless_skipped()
        elif tag in BLOCKS or self.open[at].refused:
            self.leave(at)
        elif self.last(self.BLOCK) > at:
            # An inline end tag does not end blocks opened since.
            if self.open[at] is self.link:
                self.link = None
        else:
            self.leave_inline(at)

    def leave_inline(self, at: int) -> None:
        """Close inline elements, which end a line only if they are judged for themselves."""
        if any(e.refused or e.held or e.declared for e in self.open[at:]):
            self.leave(at)
            return
        parts, self.parts = self.parts, []
        linked, tags = self.linked, self.tags
        self.leave(at)
        self.parts, self.linked, self.tags = parts, linked, tags

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.parts.append(data)
            if self.link:
                self.linked += len(data.strip())


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean over the neighbours, with the edges repeated."""
    places = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(places**2) / (2 * SIGMA**2))
    padded = np.pad(ratios, RADIUS, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def dense(ratios: np.ndarray) -> np.ndarray:
    """Lines whose smoothed ratio reaches the threshold."""
    ratios = smoothed(ratios)
    return ratios >= min(ratios.std(), ratios.max())


def of_region(lines: list[tuple[str, int, int, int]]) -> list[str]:
    """Texts of the content of one declared region.

    Dense lines, with the region's own threshold, are its clusters. Running text between two clusters is
    content, and before the first and after the last one as long as the next line kept is no farther than the
    smoothing sees. Lines of links have to be dense, with running text as near on both sides, and no
    lists of short links by their own ratio.
    """
    free = np.array([len(text) - linked for text, _, linked, _ in lines], float)
    tags = np.array([tags for _, tags, _, _ in lines], float)
    size = np.array([len(text) for text, *_ in lines], float)
    running = free > (1 - LINKS) * size
    clustered = dense(free / tags)
    # The highest ratio may fall on a line of links amid short lines; its neighbours are the cluster then.
    places = np.flatnonzero(running)
    seeds = places[clustered[places]]
    if not seeds.size:
        near = np.convolve(clustered, np.ones(2 * RADIUS + 1), mode="full")[RADIUS:-RADIUS] > 0
        seeds = places[near[places]]
    if not seeds.size:
        return []
    first, last = np.searchsorted(places, seeds[[0, -1]])
    while first > 0 and places[first] - places[first - 1] <= RADIUS + 1:
        first -= 1
    while last + 1 < len(places) and places[last + 1] - places[last] <= RADIUS + 1:
        last += 1
    places = places[first : last + 1]
    kept = np.zeros(len(lines), bool)
    kept[places] = True
    likely = clustered & (size / tags >= WORD_A_TAG)
    for before, after in zip(places[:-1], places[1:], strict=True):
        if 1 < after - before <= RADIUS + 1:
            kept[before + 1 : after] = likely[before + 1 : after]
    return [line[0] for line, keep in zip(lines, kept, strict=True) if keep]


def content(lines: list[tuple[str, int, int, int]]) -> list[str]:
    """Texts of the lines that belong to the content, in page order.

    Each declared region is judged by its own lines, so a short one counts beside a long one. If no
    region has running text, the clusters of the page count, and at last clusters of links in regions.
    """
    if not lines:
        return []
    regions: dict[int, list] = {}
    for line in lines:
        if line[3] >= 0:
            regions.setdefault(line[3], []).append(line)
    found = [text for region in regions.values() for text in of_region(region)]
    if found:
        return found
    clustered = dense(np.array([len(text) / tags for text, tags, _, _ in lines], float))
    running = clustered & np.array([linked < LINKS * len(text) for text, _, linked, _ in lines])
    found = [line[0] for line, kept in zip(lines, running, strict=True) if kept]
    return found or [line[0] for line, kept in zip(lines, clustered, strict=True) if kept and line[3] >= 0]


def main_text(html: str | None) -> str:
    """Blocks of the content joined by blanks; empty for a null or empty page or one without any.

    A tag cut off at the end of the page, with all that follows it, is no text.
    """
    if not html:
        return ""
    cut = _TAG_START.search(html, html.rfind(">") + 1)
    parser = Lines()
    parser.feed(html[: cut.start()] if cut else html)
    parser.close()
    parser.flush()
    return " ".join(content(parser.free()))


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in pages], dtype=object)

    return of(html)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of every page, replacing a column of that name.

    Every row keeps its other columns; nothing is shuffled, so copies and common hosts cost what
    their bytes cost.
    """
    kept = [c for c in pages.columns if c != into]
    return pages.select(*quoted(kept), extracted(F.col(html)).alias(into))
