"""Main text of web pages by text-to-tag ratios of their lines."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import text_slices

# Names of the HTML standard (fixed values).
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text a page doesn't show as such, and elements that are mostly boilerplate.
HIDDEN = frozenset("script style noscript template head title iframe object svg math canvas audio video map button select textarea dialog".split())
MARKED = frozenset("nav footer aside menu form".split())
#: Words in class, id and role that speak for menus, notices, adverts, sidebars and reader comments.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar widget widgets footer header masthead copyright legal "
    "comment comments commentlist respond disqus replies reply share sharing social related recommended newsletter subscribe subscription login signup search pagination pager skip toc "
    "complementary contentinfo".split()
)
#: Marks that may also name what wraps a whole page, and words in a class name that turn the mark into its opposite.
WRAPPERS = frozenset("form notice notices alert popup modal overlay sidebar widget widgets header masthead legal login signup search subscription toc social related".split())
OPPOSITES = frozenset("no non not without has with free hide hidden".split())
#: Elements that end an open paragraph or list item of the same kind.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CONTENT = frozenset(("article", "main"))
_GROUPS = frozenset(("div", "section", "td", "body", "html", *_CONTENT))
_WORDS = re.compile(r"[a-z]+")
#: Weight of a ratio inside article and main.
ARTICLE_WEIGHT = 2.0


class Line(NamedTuple):
    """What lies between two block tags.

    ``links`` are the characters in links; ``mark`` is the innermost marked element around the line
    (0: none), ``group`` the element that groups it and ``content`` the outermost article or main
    element (-1: none).
    """

    text: str
    tags: int
    links: int
    hidden: bool
    mark: int
    group: int
    content: int


class Open(NamedTuple):
    """An open element: its name, what holds for the lines in it, and whether its text is in a link.

    ``mute`` is -1 in a hidden inline element, and the mark of an inline element that is marked.
    """

    tag: str
    hidden: bool
    mark: int
    group: int
    content: int
    mute: int
    link: bool


class Lines(HTMLParser):
    """Parser events as lines, and the marked element around every marked element (``marks``); ``wrappers``
    tells which marks may name what wraps a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.marks = [0]
        self.wrappers = [True]
        self.stack = [Open("", False, 0, 0, -1, 0, False)]
        self.parts: list[str] = []
        self.linked: list[int] = []
        self.marked: list[int] = []
        self.tags = 0
        self.made = 0

    def updatepos(self, i, j):
        """Line numbers aren't kept."""
        return j

    def flush_line(self) -> None:
        top = self.stack[-1]
        # Marked inline elements part no line: it goes on without their text.
        for i in self.marked:
            self.parts[i] = ""
        text = _plain("".join(self.parts)) if self.parts else ""
        if text or self.tags:
            links = min(len(text), len(_plain(" ".join([self.parts[i] for i in self.linked])))) if self.linked else 0
            self.lines.append(Line(text, self.tags, links, top.hidden, top.mark, top.group, top.content))
        self.parts, self.linked, self.marked, self.tags = [], [], [], 0

    def _hides(self, tag: str, attrs) -> bool:
        if tag in HIDDEN:
            return True
        for name, value in attrs:
            if name in ("hidden", "inert") or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def _marks(self, tag: str, attrs, content: int) -> set[str]:
        """Names for which an element is marked."""
        if tag in MARKED or tag == "header" and content < 0:
            return {tag}
        if tag in ("html", "body", *_CONTENT):
            return set()
        found = set()
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                for token in value.lower().split():
                    words = set(_WORDS.findall(token))
                    if not words & OPPOSITES:
                        found |= words & MARKS
        return found - {"header", "legal"} if content >= 0 else found

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block:
            self.flush_line()
            self._imply_end(tag)
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        _, hidden, mark, group, content, mute, link = self.stack[-1]
        if tag in _CONTENT and not any(x.tag in _CONTENT for x in self.stack):
            # An article doesn't lie in a menu: something before it was left open.
            hidden = hidden and any(x.tag in ("template", "noscript") for x in self.stack)
            mark = 0
            mute = -1 if mute < 0 and hidden else 0
            link = False
        hides, marks = self._hides(tag, attrs), self._marks(tag, attrs, content)
        apart = block and (hides or marks or mute > 0)
        if block and mute > 0:
            mark, mute = mute, 0
        if marks:
            self.marks.append(mark)
            self.wrappers.append(marks <= WRAPPERS)
            if block:
                mark = len(self.marks) - 1
        if tag in _GROUPS or apart:
            self.made += 1
            group = self.made
            if tag in _CONTENT and content < 0:
                content = self.made
        if not block and mute >= 0:
            # A hidden or marked inline element doesn't part the line it lies in.
            mute = -1 if hides else len(self.marks) - 1 if marks and not mute else mute
        link = link or tag == "a" and any(name == "href" for name, _ in attrs)
        self.stack.append(Open(tag, hidden or hides and block, mark, group, content, mute, link))

    def _imply_end(self, tag: str) -> None:
        stack = self.stack
        if stack[-1].tag == "p" or len(stack) > 2 and "p" in (stack[-2].tag, stack[-3].tag):
            self._close("p")
        if tag in _CLOSES and stack[-1].tag in _CLOSES[tag]:
            stack.pop()

    def _close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            # An inline end tag doesn't close a block around it.
            if tag not in BLOCKS and self.stack[i].tag in BLOCKS:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush_line()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        elif tag not in VOID:
            self._close(tag)

    def handle_data(self, data):
        top = self.stack[-1]
        if top.mute < 0:
            return
        if top.link:
            self.linked.append(len(self.parts))
        if top.mute:
            self.marked.append(len(self.parts))
        self.parts.append(data)

    def unknown_decl(self, data):
        """Marked sections that are no HTML hold no text."""


def _plain(text: str) -> str:
    """Runs of white space as one blank; bytes are cut at ASCII white space alone."""
    return b" ".join(text.encode().split()).decode()


def page_lines(html: str, piece: int = 1 << 16) -> tuple[list[Line], list[int], list[bool]]:
    """Lines of a page, fed to the parser piece by piece, the mark around every mark, and which may wrap a page."""
    parser = Lines()
    for at in range(0, len(html), piece):
        parser.feed(html[at : at + piece])
    parser.close()
    parser.flush_line()
    return parser.lines, parser.marks, parser.wrappers


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing with the ends reflected."""
    half = min(int(np.ceil(3 * sigma)), len(ratios))
    kernel = np.exp(-0.5 * (np.arange(-half, half + 1) / sigma) ** 2)
    padded = np.concatenate([ratios[:half][::-1], ratios, ratios[len(ratios) - half :][::-1]])
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """Midpoint of two clusters on the line (two means, from the smallest and the largest value)."""
    low, high = values.min(), values.max()
    ordered = np.sort(values)
    sums = np.cumsum(ordered).tolist()
    n, split = len(sums), 0
    for _ in range(50):
        moved = int(np.searchsorted(ordered, (low + high) / 2, "right"))
        if moved in (split, n):
            break
        split = moved
        low, high = sums[split - 1] / split, (sums[-1] - sums[split - 1]) / (n - split)
    return (low + high) / 2


def _text_marks(lines: list[Line], marks: list[int], wrappers: list[bool], scores: list[float], cut: float) -> list[bool]:
    """Whether a mark hides nothing: it wraps the page's content.

    All marks hide, whatever their length, as long as a line outside them reaches the threshold. If none
    does, the mark that holds most of the text that does is lifted, provided its names can mean a
    wrapper; and so on inside it, until a line shows.
    """
    direct = [0] * len(marks)
    for line, score in zip(lines, scores, strict=True):
        if line.text and not line.hidden and min(score, len(line.text) / max(1, line.tags)) >= cut and 2 * line.links <= len(line.text):
            direct[line.mark] += len(line.text) - line.links
    # A mark's number is above that of the mark around it; what lies in a mark that can't be lifted counts nowhere.
    total = [n if ok else 0 for n, ok in zip(direct, wrappers, strict=True)]
    for mark in range(len(marks) - 1, 0, -1):
        total[marks[mark]] += total[mark] if wrappers[marks[mark]] else 0
    # Of the marks in each mark, the one with most text.
    heaviest: dict[int, int] = {}
    for mark in range(1, len(marks)):
        around = marks[mark]
        if wrappers[mark] and total[mark] and (around not in heaviest or total[mark] > total[heaviest[around]]):
            heaviest[around] = mark
    shown = [mark == 0 for mark in range(len(marks))]
    at = 0
    while not direct[at] and at in heaviest:
        at = heaviest[at]
        shown[at] = True
    return shown


def main_text(html: str, sigma: float = 1.0) -> str:
    """Main text of one page: the lines of its content regions, one per block.

    A line's ratio is its characters over its tags. The smoothed ratios of all lines, menus and
    notices included, are clustered; regions are the nearest grouping elements, and a region is
    content if a line of its own reaches the threshold. A content region gives all its lines.

    Article and main elements are a weight: their ratios count twice, on pages with one a line
    outside has to reach the threshold unsmoothed as well, and in an article or main element that
    reaches it, only regions are left out that don't and are mostly links. Marks (elements and
    class words) leave out what lies in them at any length; one is lifted only where no line outside reaches the
    threshold and its name can mean a wrapper of the page. The region with most text outside links is always content, and so is the
    largest article or main element unless it is mostly links.
    """
    lines, marks, wrappers = page_lines(html)
    if not any(line.text and not line.hidden for line in lines):
        return ""
    scores = smoothed(np.array([len(line.text) / max(1, line.tags) for line in lines]), sigma).tolist()
    cut = threshold(np.array(scores))
    shown = _text_marks(lines, marks, wrappers, scores, cut)
    kept = [(line, score) for line, score in zip(lines, scores, strict=True) if line.text and not line.hidden and shown[line.mark]]
    if not kept:
        return ""
    articles = any(line.content >= 0 for line, _ in kept)
    # Characters outside links, all characters and the highest ratio of regions and of articles.
    regions: dict[tuple[int, int], list[float]] = {}
    contents: dict[int, list[float]] = {}
    for line, score in kept:
        inside = line.content >= 0
        if inside:
            score *= ARTICLE_WEIGHT
        elif articles:
            score = min(score, len(line.text) / max(1, line.tags))
        size = len(line.text)
        for held, key in ((regions, (line.content, line.group)), (contents, line.content)):
            sums = held.setdefault(key, [0, 0, 0.0])
            sums[0] += size - line.links
            sums[1] += size
            sums[2] = max(sums[2], score)
    largest = max(regions, key=lambda r: regions[r][:2])
    contents.pop(-1, None)
    chosen = {c for c, (_, _, best) in contents.items() if best >= cut} | {largest[0]}
    if contents:
        first = max(contents, key=lambda c: contents[c][:2])
        if 2 * contents[first][0] >= contents[first][1]:
            chosen.add(first)

    def content(region: tuple[int, int]) -> bool:
        plain, size, best = regions[region]
        if region == largest:
            return True
        return best >= cut and (region[0] < 0 or region[0] in chosen) or region[0] >= 0 and region[0] in chosen and 2 * plain >= size

    found = {region for region in regions if content(region)}
    return "\n".join(line.text for line, _ in kept if (line.content, line.group) in found)


def extract_main_text(pages: DataFrame, html: str = "html", text: str = "text", keep: tuple[str, ...] = ("page_id", "url"), sigma: float = 1.0) -> DataFrame:
    """Main text of every page from its whole HTML, with the columns in ``keep``.

    Null HTML counts as empty; a page without main text has an empty one. Character references are
    decoded, white space inside a block becomes one blank, blocks are joined by a line feed.
    Repeated rows give repeated rows, an empty table an empty one; broken markup is read as the
    parser can. One pass without a shuffle, a page at a time.
    """
    rows = pages.select(*keep, F.col(html).alias("_html"))
    schema = f"{''.join(f'`{f.name}` {f.dataType.simpleString()}, ' for f in rows.schema.fields[:-1])}`{text}` string"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sources in text_slices(batches, "_html"):
            texts = pa.array([main_text(source.as_py(), sigma) for source in sources], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*keep, text])

    return rows.mapInArrow(extract, schema)
