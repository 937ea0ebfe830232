"""Main text of web pages by tag ratios over parser events."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemill.llm import kernels

# HTML's elements by what they are to a reader.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PASSAGES = HEADINGS | frozenset("p blockquote pre li dt dd td th caption figcaption".split())
SKIPPED = frozenset("script style head title svg annotation annotation-xml".split())
FALLBACK = frozenset("noscript template iframe object canvas audio video".split())
FRAME = frozenset("nav footer aside form menu dialog button select textarea option label input fieldset header".split())
CLOSED_BY_SIBLING = frozenset("p li dt dd tr td th option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_NAME = r"(^|[-_\s])({})([-_\s]|$)"
ADVERT_NAMES = re.compile(_NAME.format(r"ad|ads|advert\w*|sponsor\w*|promo\w*|share|sharing|social"))
READER_NAMES = re.compile(_NAME.format(r"comments?|replies|reply|disqus|respond"))
FRAME_NAMES = re.compile(
    _NAME.format(
        r"banner|cookies?|consent|gdpr|notice|alert|sidebar|menu|nav\w*|breadcrumbs?|footer|related|recommended|newsletter|"
        r"subscribe|subscription|popup|modal|overlay|widget|login|signup|toolbar|pagination|pager|skip"
    )
)
HEADER_NAMES = re.compile(_NAME.format(r"header|masthead"))
READER_HEADING = re.compile(
    r"\W*(\d+\W+)?(reader |user |all )?(comments?|kommentare?|commentaires?|comentarios?|responses?|replies|"
    r"discussion|leave a (reply|comment))\b.{0,24}", re.I
)
SIGMA = 1.0

# What an element's tag, role or name says of its text.
PLAIN, FRAMED, HEADED, ADVERT, READERS, HIDDEN = range(6)


@dataclass
class _Element:
    tag: str
    kind: int
    named: bool  # the kind comes from a name only
    depth: int


@dataclass
class _Line:
    """A block of text, with the tags since the block before and the elements it stands in."""

    text: str
    tags: int
    path: tuple[int, ...]
    linked: int  # characters inside links


class _Lines(HTMLParser):
    """The blocks of a page in order, and all elements that were opened."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.elements: list[_Element] = []
        self._open: list[int] = []
        self._skipped: list[str] = []
        self._text: list[str] = []
        self._tags = self._linked = 0
        self._marks: dict[int, int] = {}  # where the text of an open fallback begins

    def _break(self):
        text = " ".join("".join(self._text).split())
        if text:
            self.lines.append(_Line(text, self._tags, tuple(self._open), self._linked))
            self._tags = 0
        self._text, self._linked, self._marks = [], 0, {}

    def _said(self, tag: str, attrs) -> tuple[int, bool]:
        names, kind = [], PLAIN
        for name, value in attrs:
            if name in ("class", "id") and value:
                names.append(value.lower())
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return HIDDEN, False
            elif name == "role" and value and value.lower() in FRAME_ROLES:
                kind = FRAMED
        if tag in FRAME:
            return (HEADED if tag == "header" else FRAMED), False
        if kind:
            return kind, False
        for kind, pattern in ((ADVERT, ADVERT_NAMES), (READERS, READER_NAMES), (FRAMED, FRAME_NAMES), (HEADED, HEADER_NAMES)):
            if any(map(pattern.search, names)):
                return kind, True
        return PLAIN, False

    def handle_starttag(self, tag, attrs):
        self._tags += 1
        if tag in SKIPPED:
            if tag == "head":
                self._break()
            self._skipped.append(tag)
            return
        if self._skipped:
            if self._skipped[0] == "head" and tag in BLOCKS:
                self._skipped = []  # a head that is never closed
            else:
                return
        if tag in VOID:
            if tag == "hr":
                self._break()
            elif not self._dropped():
                self._text.append(" ")
            return
        if tag in BLOCKS:
            self._break()
            self._close(tag if tag in CLOSED_BY_SIBLING else "p", within=BLOCKS - CLOSED_BY_SIBLING)
        kind, named = self._said(tag, attrs)
        self.elements.append(_Element(tag, kind, named, len(self._open)))
        self._open.append(len(self.elements) - 1)

    def handle_startendtag(self, tag, attrs):
        if tag not in SKIPPED:
            self.handle_starttag(tag, attrs)
            if tag not in VOID and tag not in BLOCKS:
                self.handle_endtag(tag)

    def _close(self, tag: str, within: frozenset = frozenset()):
        """Close the innermost open ``tag``, unless one of ``within`` stands in between.

        What closes with it and is only shown where something else fails is hidden. Where nothing ever closes it, it may hold the
        rest of the page.
        """
        for at in range(len(self._open) - 1, -1, -1):
            name = self.elements[self._open[at]].tag
            if name == tag:
                if name in BLOCKS or any(self.elements[n].tag in BLOCKS for n in self._open[at:]):
                    self._break()
                for number in self._open[at:]:
                    if self.elements[number].tag in FALLBACK:
                        self.elements[number].kind = HIDDEN
                del self._open[at:]
                return
            if name in within:
                return

    def handle_endtag(self, tag):
        self._tags += 1
        if self._skipped:
            if tag in self._skipped:
                while self._skipped.pop() != tag:
                    pass
            return
        if tag in FALLBACK:
            self._break_hidden(tag)
        if tag in BLOCKS:
            self._break()
            self._close(tag)
        else:
            self._close(tag, within=BLOCKS)

    def _break_hidden(self, tag: str):
        """Text of a fallback inside a sentence is taken out of it."""
        for at in range(len(self._open) - 1, -1, -1):
            if self.elements[self._open[at]].tag == tag:
                mark = self._marks.pop(self._open[at], None)
                if mark is not None and mark <= len(self._text):
                    del self._text[mark:]
                return

    def _dropped(self) -> bool:
        """Inside an advert in the middle of a block."""
        for number in reversed(self._open):
            element = self.elements[number]
            if element.tag in BLOCKS:
                return False
            if element.kind in (ADVERT, HIDDEN) or element.tag in ("button", "select", "textarea", "option", "label"):
                return True
        return False

    def handle_data(self, data):
        if self._skipped or self._dropped():
            return
        for number in reversed(self._open):
            tag = self.elements[number].tag
            if tag in BLOCKS:
                break
            if tag in FALLBACK:
                self._marks.setdefault(number, len(self._text))
            elif tag == "a":
                self._linked += len(data.strip())
        self._text.append(data)

    def close(self):
        super().close()
        self._break()


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel keeps its whole weight."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, kernel)[reach:-reach] / np.convolve(np.ones(len(values)), kernel)[reach:-reach]


def threshold(values: np.ndarray) -> float:
    """Middle between the two clusters of a one-dimensional 2-means."""
    low, high = values.min(), values.max()
    while True:
        middle = (low + high) / 2
        upper = values >= middle
        if upper.all() or not upper.any():
            return low
        now = values[~upper].mean(), values[upper].mean()
        if now == (low, high):
            return middle
        low, high = now


class _Page:
    """Which lines of a page are its article."""

    def __init__(self, lines: list[_Line], elements: list[_Element]):
        self.lines, self.elements = lines, elements
        self.first = [-1] * len(elements)  # line of each element
        self.titled: set[int] = set()  # elements that hold the page's title
        for place, line in enumerate(lines):
            title = any(elements[n].tag == "h1" for n in line.path)
            for number in line.path:
                if self.first[number] < 0:
                    self.first[number] = place
                if title:
                    self.titled.add(number)

    def _upper(self, lines: list[_Line]) -> list[_Line]:
        """The lines in the upper of two clusters of smoothed ratios of text to tags; links are no text."""
        if not lines:
            return []
        ratios = np.array([max(0, len(x.text) - x.linked) / max(1, x.tags) for x in lines])
        even = smoothed(ratios)
        return [x for x, chosen in zip(lines, even >= threshold(even)) if chosen]

    def _weights(self, lines: list[_Line]) -> dict[int, int]:
        weights: dict[int, int] = {}
        for line in lines:
            for number in line.path:
                weights[number] = weights.get(number, 0) + len(line.text)
        return weights

    def _within(self, line: _Line, kinds: tuple[int, ...]) -> bool:
        return any(self.elements[n].kind in kinds for n in line.path)

    def _article(self, lines: list[_Line]) -> int | None:
        """The article or main element with most text."""
        weights = self._weights(lines)
        named = [n for n in weights if self.elements[n].tag in ("article", "main")]
        if not named:
            return None
        best = max(named, key=lambda n: (weights[n], -n))
        inner = [n for n in named if n != best and 2 * weights[n] > weights[best] and self._holds(best, n)]
        return max(inner, default=best)

    def _holds(self, outer: int, inner: int) -> bool:
        return outer in self.lines[self.first[inner]].path

    def _counts(self, number: int, region: int | None, ancestors: frozenset[int], weights: dict[int, int], total: int) -> bool:
        """Whether what an element says of its text is believed."""
        element = self.elements[number]
        if element.kind in (PLAIN, HIDDEN):
            return element.kind == HIDDEN
        if number in ancestors or number == region:
            return False
        may_frame = element.named or element.tag in ("form", "header", "fieldset")
        if may_frame and element.kind in (FRAMED, HEADED) and 2 * weights.get(number, 0) > total:
            return False  # it frames the text itself
        inside = region is not None and self._holds(region, number)
        if inside and element.kind == HEADED:
            return False  # the article's own head
        if element.named:
            if element.tag in HEADINGS:
                return False
            if element.tag in PASSAGES:
                return element.kind == ADVERT
            return not (inside and number in self.titled and element.kind == FRAMED)
        return True

    def kept(self) -> list[str]:
        seen = [i for i, x in enumerate(self.lines) if not self._within(x, (HIDDEN, READERS, ADVERT))]
        seen = [self.lines[i] for i in sorted(self._without_readers(seen))]
        region = self._article(seen)
        path = self.lines[self.first[region]].path if region is not None else ()
        ancestors = frozenset(path[: path.index(region)] if path else ())
        weights = self._weights(self._upper(seen))
        total = max([*weights.values(), 0])
        said = [n for n, element in enumerate(self.elements) if element.kind and self.first[n] >= 0]
        believed = {n for n in said if self._counts(n, region, ancestors, weights, total)}
        shown = [i for i, x in enumerate(self.lines) if believed.isdisjoint(x.path)]
        lines = [self.lines[i] for i in sorted(self._without_readers(shown))]
        if region is None:
            return [x.text for x in self._around(lines)]
        return [x.text for x in lines if region in x.path]

    def _without_readers(self, places: list[int]) -> set[int]:
        """Without what follows a heading of readers' comments inside the element that the heading stands in."""
        kept, before = set(), 0
        over: int | None = None
        for place in places:
            line = self.lines[place]
            if over is not None and over in line.path:
                continue
            over = None
            heads = any(self.elements[n].tag in HEADINGS for n in line.path)
            if heads and before and READER_HEADING.fullmatch(line.text):
                parents = [n for n in line.path if self.elements[n].tag in BLOCKS - HEADINGS]
                over = parents[-1] if parents else None
                if over is not None:
                    continue
            kept.add(place)
            before += len(line.text)
        return kept

    def _around(self, lines: list[_Line]) -> list[_Line]:
        """Without an article element: the lowest element that holds most of the upper lines, and the passages next to it."""
        upper = self._upper(lines)
        weights = self._weights(upper)
        total = sum(len(x.text) for x in upper)
        held = [n for n, weight in weights.items() if 2 * weight > total and self.elements[n].tag not in PASSAGES]
        region = max(held, default=None)
        if region is None:
            return lines
        inside = [i for i, x in enumerate(lines) if region in x.path]
        first, last = inside[0], inside[-1]
        while last + 1 < len(lines) and self._passage(lines[last + 1]):
            last += 1
        while first and (self._passage(lines[first - 1]) or any(self.elements[n].tag in HEADINGS for n in lines[first - 1].path)):
            first -= 1
        return lines[first : last + 1]

    def _passage(self, line: _Line) -> bool:
        """A block that reads like a part of the article: in a passage element or a sentence, and not made of links."""
        if 2 * line.linked > len(line.text) or re.match(r"\W*(©|\(c\)|copyright\b)", line.text, re.I):
            return False
        return any(self.elements[n].tag in PASSAGES for n in line.path[-2:]) or line.text[-1] in ".!?…\"”»"


def main_text(html: str) -> str:
    """The text of a page's article.

    Every block is a line with the ratio of its characters outside links to the tags since the line before. Smoothed ratios
    fall into two clusters. The region is the article or main element with most text, else the lowest element that holds
    most of the upper cluster's characters, with the passages next to it. Tags, roles and names of elements take menus, adverts and comments
    out of it; a name is no more than a hint: it is not believed of an element that holds the region or most of the
    upper lines, of a heading, or of a single passage unless that is an advert.
    """
    parser = _Lines()
    parser.feed(html)
    parser.close()
    return "\n".join(_Page(parser.lines, parser.elements).kept()) if parser.lines else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in kernels.blocks(batches, "html"):
        texts = [main_text(html) if html else "" for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, in one pass without a shuffle.

    Null and empty pages have an empty text; null ids and addresses stay null; repeated rows give equal rows.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        _texts, "page_id bigint, url string, text string, n_chars bigint"
    )
