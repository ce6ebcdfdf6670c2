"""Main-text extraction from HTML.

The page is read as the event stream of the standard-library parser.  Block
boundaries end a *line*; each line has its text, the number of tags met in it
and hence a text-to-tag ratio.  The ratios are smoothed with a Gaussian over
neighbouring lines and split in two clusters (1-d two-means); lines of the
upper cluster mark content regions.  Marks choose between ``article`` and ``main`` containers: those with
marked lines are regions, unless more of the marked text lies outside of all containers.  Then, and on pages without
containers, the region is the innermost block element that encloses all marked lines, so headings and short blocks at the
ends stay.  Inside a region lists, tables, divs and lines without a mark go if they are little but links; short text is
no reason to go.  Where the region is no element but the whole page, a div or section of several lines without a mark or heading
goes too.  Content of menus, page headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments (by element, or by a word of class, id or role) makes no lines at all.  On a page
that has no container outside of them, an element with such a word that holds an article or main is read all the same, and
so is one that holds most of the page's text, unless it is one of comments, adverts or consent.

Defined cases: null or empty html gives an empty text; tags left open are
closed by their container; a page without markup is one block; very long and deeply nested pages are
parsed whole, in time that grows with their length; repeated rows are extracted each; an empty table gives an empty result.
Columns other than the html are carried by `extract_pages` only where asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style noscript template nav footer aside form button select textarea iframe svg canvas "
                    "object dialog menu header figure audio video".split())
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption h1 h2 h3 h4 "
                   "h5 h6 hr html li main ol p pre section summary table tbody tfoot thead tr ul".split())
SPACES = frozenset("br td th".split())
CONTAINERS = frozenset(("article", "main"))
KEPT_INSIDE = frozenset(("header", "figure"))
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
LISTS = frozenset(("ul", "ol", "dl", "table"))
UNWANTED = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar aside nav navbar "
                     "navigation menu breadcrumb breadcrumbs footer masthead topbar cookie cookies consent notice alert popup "
                     "modal newsletter subscribe signup share sharing social related recommended comment comments "
                     "disqus respond reply replies pagination pager widget complementary contentinfo search".split())
FOREIGN = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent comment "
                    "comments disqus respond reply replies".split())
SECTIONS = frozenset("article blockquote div dl main ol section table ul".split())
WRAPPERS = frozenset(("div", "section"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())


class LineParser(HTMLParser):
    """Collects (text, tags, container, section, heading, links) lines from parser events.

    ``read``: start tags, by number, of elements with an unwanted word that are read all the same."""

    def __init__(self, read: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool, int]] = []
        self.stack: list[tuple[str, bool, int, int]] = []
        self.sections: list[tuple[int, str]] = [(-1, "body")]  # (enclosing section, tag)
        self.section, self.heading, self.links = 0, False, 0
        self.read = read
        self.opened = 0  # start tags met
        # of skipped elements with an unwanted word, by number: characters, holds an article or main, is foreign, lies in no other
        self.named: dict[int, list] = {}
        self.open: list[tuple[int, int]] = []  # those that are open: number, depth
        self.mute = 0  # the depth from which their text doesn't count
        self.skipping = 0
        self.container, self.containers = 0, 0
        self.text: list[str] = []
        self.tags = 0

    def updatepos(self, i: int, j: int) -> int:
        """Line and column numbers, which nothing here uses, are not counted."""
        return j

    def end_line(self) -> None:
        if self.text:
            if text := " ".join("".join(self.text).split()):
                self.lines.append((text, self.tags, self.container, self.section, self.heading, self.links))
                self.tags, self.heading, self.links = 0, False, 0
            self.text = []

    def unwanted(self, tag: str, attrs: list) -> bool:
        if tag in SKIPPED and not (self.container and tag in KEPT_INSIDE):
            return True
        if tag in ("html", "body"):
            return False
        for name, value in attrs:
            if name in ("class", "id") and value:
                if tag not in CONTAINERS and (words := UNWANTED.intersection(re.split(r"[\s_-]+", value.lower()))):
                    if self.opened in self.read:
                        continue
                    self.enter(tag, words)
                    return True
                if tag == "article" and "comment" in value.lower():
                    return True
            elif name == "role" and value and value.lower() in UNWANTED_ROLES:
                return True
            elif name == "hidden":
                return True
        return False

    def enter(self, tag: str, words: set[str]) -> None:
        """A skipped element with unwanted words begins."""
        if tag not in VOID:
            self.named[self.opened] = [0, False, not FOREIGN.isdisjoint(words), not self.open]
            self.open.append((self.opened, len(self.stack)))
            self.mute = 0

    def leave(self) -> None:
        """It ends: what it held counts for the one around it."""
        inner, _ = self.open.pop()
        if self.open:
            outer = self.named[self.open[-1][0]]
            outer[0] += self.named[inner][0]
            outer[1] |= self.named[inner][1]

    def pop(self) -> None:
        tag, skipped, outer, section = self.stack.pop()
        self.skipping -= skipped
        while self.open and self.open[-1][1] >= len(self.stack):
            self.leave()
        if len(self.stack) < self.mute:
            self.mute = 0
        if self.container != outer:
            self.end_line()
            self.container = outer
        elif tag in BLOCKS and not self.skipping:
            self.end_line()
        self.section = section

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.opened += 1
        if tag in BLOCKS or tag in CLOSES:
            closed = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
            for depth in range(len(self.stack) - 1, -1, -1):
                name = self.stack[depth][0]
                if name in closed:
                    while len(self.stack) > depth:
                        self.pop()
                    break
                if name in LISTS or name in CONTAINERS or name in SKIPPED or name in ("div", "section", "body"):
                    break
        if self.open and not self.mute and tag not in VOID:
            words = [v.lower() for n, v in attrs if n in ("class", "id") and v]
            if tag in SKIPPED:
                self.mute = len(self.stack) + 1
            elif tag in CONTAINERS:
                if not any("comment" in v for v in words):
                    self.named[self.open[-1][0]][1] = True
            elif found := UNWANTED.intersection(w for v in words for w in re.split(r"[\s_-]+", v)):
                self.enter(tag, found)
        skipped = not self.skipping and self.unwanted(tag, attrs) or bool(self.skipping)
        if not skipped:
            if tag in BLOCKS:
                self.end_line()
            elif tag in SPACES:
                self.text.append(" ")
            self.tags += 1
            self.heading |= tag in HEADINGS
            self.links += tag == "a"
        elif not self.skipping and tag not in VOID:
            self.end_line()
        if tag in VOID:
            return
        self.stack.append((tag, skipped, self.container, self.section))
        if tag in SECTIONS and not skipped:
            self.sections.append((self.section, tag))
            self.section = len(self.sections) - 1
        self.skipping += skipped
        if tag in CONTAINERS and not skipped and not self.container:
            self.containers += 1
            self.container = self.containers

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if not self.skipping:
            self.tags += 1
            if tag in SPACES:
                self.text.append(" ")
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                while len(self.stack) > depth:
                    self.pop()
                return

    def handle_data(self, data: str) -> None:
        if not self.skipping:
            self.text.append(data)
        elif self.open and not self.mute:
            self.named[self.open[-1][0]][0] += len(data.strip())


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over line numbers; edges are renormalised."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weighed = np.convolve(ratios, kernel)[reach:reach + len(ratios)]
    return weighed / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]


def upper_cluster(values: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Mask of the upper of two 1-d clusters; all, if the values don't differ."""
    low, high = float(values.min()), float(values.max())
    if high - low < 1e-9:
        return np.ones(len(values), bool)
    for _ in range(rounds):
        up = values > (low + high) / 2
        moved = float(values[~up].mean()), float(values[up].mean())
        if moved == (low, high):
            break
        low, high = moved
    return values > (low + high) / 2


def parsed(html: str, read: frozenset[int] = frozenset()) -> LineParser:
    parser = LineParser(read)
    parser.feed(html)
    parser.close()
    parser.end_line()
    while parser.open:
        parser.leave()
    return parser


def read_lines(html: str) -> LineParser:
    """The parsed page; parsed once more with the unwanted elements that turn out to hold its content."""
    parser = parsed(html)
    if not parser.named or any(line[2] for line in parser.lines):
        return parser
    whole = sum(len(line[0]) for line in parser.lines) + sum(n for n, _, _, outermost in parser.named.values() if outermost)
    read = frozenset(i for i, (n, holds, foreign, _) in parser.named.items() if holds or 2 * n > whole and not foreign)
    return parsed(html, read) if read else parser


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The text blocks of the content regions, joined by blank lines."""
    if not html:
        return ""
    parser = read_lines(html)
    lines, sections = parser.lines, parser.sections
    if not lines:
        return ""
    ratios = np.array([len(line[0]) / max(1, line[1]) for line in lines])
    marked = upper_cluster(smooth(np.log1p(ratios), sigma))
    sizes = np.array([len(line[0]) for line in lines])
    inside = np.array([line[2] for line in lines])
    tree, whole_page = Sections(lines, sections, marked), False
    if inside.any() and (2 * sizes[marked & (inside > 0)].sum() >= sizes[marked].sum()):
        regions = set(inside[marked & (inside > 0)].tolist()) or set(inside[inside > 0].tolist())
        taken = np.array([c in regions for c in inside.tolist()])
    else:
        region = tree.shared()
        while region and sections[region][1] not in WRAPPERS | CONTAINERS:
            region = sections[region][0]  # a list or quotation is part of a text
        while region and tree.lines[region] == 1:
            region = sections[region][0]  # a wrapper of one line
        taken = tree.below({region})[tree.at]
        whole_page = not region
    taken &= ~tree.unwanted(whole_page)
    return "\n\n".join(lines[i][0] for i in np.flatnonzero(taken))


class Sections:
    """What the sections of a page hold, their inner sections included: one pass from the last to the first,
    as a section comes after the one around it."""

    def __init__(self, lines: list[tuple], sections: list[tuple[int, str]], marked: np.ndarray):
        self.sections, self.marked = sections, marked
        self.at = np.array([line[3] for line in lines])
        self.links = np.array([line[5] for line in lines])
        self.words = np.array([len(line[0].split()) for line in lines])
        self.heads = np.array([line[4] for line in lines], dtype=int)
        many = len(sections)
        totals = np.column_stack([np.bincount(self.at, weights, many) for weights in (None, marked, self.links, self.words, self.heads)]).tolist()
        for i in range(many - 1, 0, -1):
            outer = totals[sections[i][0]]
            for k, value in enumerate(totals[i]):
                outer[k] += value
        self.lines, self.marks, self.all_links, self.all_words, self.all_heads = np.array(totals).T

    def shared(self) -> int:
        """The innermost section that encloses all marked lines."""
        return int(np.flatnonzero(self.marks == self.marked.sum())[-1])

    def below(self, chosen: set[int]) -> np.ndarray:
        """Mask of the sections that are chosen or lie in a chosen one."""
        out = np.zeros(len(self.sections), bool)
        for i, (outer, _) in enumerate(self.sections):
            out[i] = i in chosen or (outer >= 0 and out[outer])
        return out

    def unwanted(self, whole_page: bool) -> np.ndarray:
        """Mask of the lines without a mark in blocks of little but links, and (where the whole page is the region)
        of those in blocks of several lines under no heading."""
        if self.marked.all():
            return np.zeros(len(self.at), bool)
        tags = [tag for _, tag in self.sections]
        linked = (self.all_links > 1) & (2 * self.all_links > self.all_words)
        plain = (self.all_heads == 0) & (self.lines > 1) & np.array([t in WRAPPERS for t in tags]) & whole_page
        block = (self.marks == 0) & (self.lines > 0) & np.array([t not in CONTAINERS for t in tags]) & (linked | plain)
        block[0] = False
        own = ~self.marked & (self.heads == 0) & (self.links > 1) & (2 * self.links > self.words)
        return own | self.below(set(np.flatnonzero(block).tolist()))[self.at]


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
                  sigma: float = 1.0) -> DataFrame:
    """Columns ``keep``, then text and n_chars (code points)."""

    @F.pandas_udf("string")
    def texts(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in column:
            yield pd.Series([main_text(x, sigma) for x in html], dtype=object)

    return (pages.select(*[pages[c] for c in keep], texts(pages[html_col].cast("string")).alias("text"))
            .select(*keep, "text", F.length("text").cast("long").alias("n_chars")))
