"""Main text of web pages by the distribution of text over line blocks.

A forward tokenizer strips markup into lines: a line is the text of one block element. Page furniture (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments, by element and by class, id or
role) drops out, and where a page has <article> or <main> so does what lies outside. A line weighs as many characters
as it has outside links. Sums over a sliding window of BLOCK lines show where text surges and where it dives:

* a block without any weight is a trough. Its lines, a run of bare links, are left out, inside <article> as well;
* a segment of text holds a block of SURGE characters, and goes from there to the troughs around it; before its
  first surge only a heading is taken in. All segments are kept, short paragraphs included. In <article>
  or <main> any weight is a surge, as the element has told already that text is there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from quaymill.llm.common import append_columns

BLOCK = 3
SURGE = 80

# Elements whose content is no text of the page.
_HIDDEN = frozenset(
    "script style head template noscript iframe svg select textarea button object canvas".split()
)
_HIDDEN_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _HIDDEN}
_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
# Up to what a start tag needs a decision on: its end, or the opening quote of a value.
_STEP = re.compile(r">|=\s*[\"']")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
_FURNITURE = frozenset("nav footer aside form menu dialog".split())
_CONTENT = frozenset(("article", "main"))
# Headers of the page are furniture, those of an article are part of it.
_LABEL = re.compile(r"(?:\bclass|\bid|\brole|\baria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_FURNITURE_WORD = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|side|aside|"
    r"header|masthead|footer|foot|cookies?|consent|notice|gdpr|popup|modal|newsletter|subscribe|"
    r"comments?|respond|disqus|replies|social|share|sharing|related|recommended|widget|login|signup|"
    r"search|form|pagination|pager|skip|legal|copyright|toolbar|contentinfo|navigation|complementary)",
    re.I,
)
# Words that name the place or form of furniture, but no state of another element (with, has, no, open).
_NEUTRAL_WORD = re.compile(
    r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|bar|box|block|area|list|links?|"
    r"items?|buttons?|container|wrapper|wrap|section|inner|text|icons?|posts?|message|"
    r"slots?|units?|google|body|users?|readers?|articles|stories|law|tools?|placeholder|feed|thread|count|\d+)",
    re.I,
)
# An article has such parts of its own.
_OUTSIDE_WORD = re.compile(r"header|masthead|footer|foot|side|banner", re.I)
# Which open elements a start tag ends, and which elements bound the search for them.
_ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_BOUNDS = {"li": ("ul", "ol", "menu", "dir"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}


@lru_cache(4096)
def _names_furniture(label: str, inside: bool) -> bool:
    """Whether a whole token of the label is made of furniture words and neutral words only."""
    for token in label.split():
        words = [word for word in re.split(r"[_-]+", token) if word]
        named = [word for word in words if _FURNITURE_WORD.fullmatch(word)]
        if inside:
            named = [word for word in named if not _OUTSIDE_WORD.fullmatch(word)]
        if named and all(word in named or _NEUTRAL_WORD.fullmatch(word) for word in words):
            return True
    return False


class OpenElements:
    """The open block elements; where each name stands, so that no search walks over the others."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool, bool]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, bad: bool, inside: bool, firm: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, bad, inside, firm))

    def state(self) -> tuple[bool, bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False, False)

    def _nearest(self, names: tuple[str, ...]) -> int:
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=-1)

    def _cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.places[self.stack.pop()[0]].pop()

    def close(self, name: str) -> None:
        depth = self._nearest((name,))
        if depth >= 0:
            self._cut(depth)

    def end_implied(self, name: str) -> None:
        """Close what a start tag closes: a paragraph, or the item, cell or row before."""
        if self.stack and self.stack[-1][0] == "p":
            self._cut(len(self.stack) - 1)
        bound = self._nearest(_BOUNDS.get(name, ()))
        while (depth := self._nearest(_ENDS.get(name, ()))) > bound:
            self._cut(depth)
            if name != "tr":
                return


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """Text as ("", "", text), tags as ("/" or "<", name, attributes); comments and hidden elements are skipped.

    Every step moves forward and every search that fails is not made again, so time grows with the page.
    What the end of the page cuts off is dropped.
    """
    at, size = 0, len(html)
    last = {mark: html.rfind(mark) for mark in (">", '"', "'")}
    while at < size:
        start = html.find("<", at)
        if start < 0:
            yield "", "", html[at:]
            return
        if start > at:
            yield "", "", html[at:start]
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
            yield "", "", " "
            continue
        if html.startswith("<![CDATA[", start):
            end = html.find("]]>", start)
            at = size if end < 0 else end + 3
            yield "", "", " "
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start) if start < last[">"] else -1
            at = size if end < 0 else end + 1
            yield "", "", " "
            continue
        name = _NAME.match(html, start + 1)
        if name is None:
            yield "", "", "<"
            at = start + 1
            continue
        end = name.end()
        while True:
            step = _STEP.search(html, end) if end <= last[">"] else None
            if step is None:
                return
            end = step.end()
            mark = html[end - 1]
            if mark == ">":
                break
            if end <= last[mark]:
                end = html.find(mark, end) + 1
        at = end
        closing, lowered = name.group(1), name.group(2).lower()
        attributes = html[name.end() : end - 1]
        if lowered in _HIDDEN:
            if not closing and not attributes.endswith("/"):
                found = _HIDDEN_END[lowered].search(html, end)
                at = size if found is None else found.end()
            yield "", "", " "
            continue
        yield closing or "<", lowered, attributes


class Line(NamedTuple):
    text: str
    weight: int
    """Characters outside links."""
    furniture: bool
    content: bool
    """In <article> or <main>."""
    heading: bool


def page_lines(html: str) -> list[Line]:
    lines: list[Line] = []
    pieces: list[str] = []
    linked: list[str] = []
    opened = OpenElements()
    # Furniture, in content, furniture by an element and not only by a label.
    state = (False, False, False)
    in_link, link_depth = False, 0

    def flush() -> None:
        line = " ".join(unescape("".join(pieces)).split())
        outside = sum(map(len, line.split())) - sum(map(len, unescape("".join(linked)).split()))
        pieces.clear()
        linked.clear()
        if line:
            heading = bool(opened.stack) and opened.stack[-1][0] in _HEADINGS
            lines.append(Line(line, max(outside, 0), state[0], state[1], heading))

    for kind, name, attributes in tokens(html):
        if not kind:
            pieces.append(attributes)
            if in_link:
                linked.append(attributes)
            continue
        closing = kind == "/"
        if name == "br":
            pieces.append(" ")
        if name == "a":
            in_link = not closing
            link_depth = len(opened.stack)
        if name not in _BLOCKS:
            continue
        flush()
        if closing:
            opened.close(name)
            # A link that was never closed ends with the block around it.
            in_link = in_link and len(opened.stack) >= link_depth
        elif name not in _EMPTY and not attributes.endswith("/"):
            opened.end_implied(name)
            state = opened.state()
            # <article> and <main> start afresh from what a wrapper's label says.
            inside = state[1] or name in _CONTENT
            fresh = name in _CONTENT and not state[1]
            firm = state[2] or name in _FURNITURE or (name == "header" and not inside)
            bad = firm or (state[0] and not fresh)
            if not bad and attributes and name not in ("html", "body"):
                labels = (next(filter(None, m), "") for m in _LABEL.findall(attributes))
                bad = any(_names_furniture(label, inside) for label in labels)
            opened.push(name, bad, inside, firm)
        state = opened.state()
    flush()
    return lines


def text_lines(lines: list[Line]) -> list[Line]:
    """The lines between surges and dives."""
    counted = [line for line in lines if not line.furniture]
    marked = any(line.content for line in counted)
    if marked:
        counted = [line for line in counted if line.content]
    if not counted:
        return []
    weights = np.array([line.weight for line in counted])
    sums = np.concatenate([[0], np.cumsum(weights)])
    last = np.minimum(np.arange(len(weights)) + BLOCK, len(weights))
    blocks = sums[last] - sums[:-1]
    # Lines that a whole block without weight covers.
    trough = np.zeros(len(weights) + 1, int)
    empty = np.flatnonzero((blocks == 0) & (last - np.arange(len(weights)) == BLOCK))
    np.add.at(trough, empty, 1)
    np.add.at(trough, empty + BLOCK, -1)
    trough = np.cumsum(trough)[:-1] > 0
    if marked:
        return [line for line, low in zip(counted, trough) if not low]
    surges = np.flatnonzero((blocks >= max(1, min(SURGE, int(blocks.max())))) & (weights > 0))
    kept: list[Line] = []
    end = 0
    for surge in surges:
        if surge < end:
            continue
        start = int(surge)
        while start > end and counted[start - 1].heading and not trough[start - 1]:
            start -= 1
        end = int(surge)
        while end < len(counted) and not trough[end]:
            end += 1
        segment = counted[start:end]
        # A link or two at the end of a segment are on their way to a dive.
        while segment and not segment[-1].weight:
            segment.pop()
        kept += segment
    return kept


def main_text(html: str | None) -> str:
    """The kept lines, joined by an empty line; empty if there are none."""
    return "\n\n".join(line.text for line in text_lines(page_lines(html))) if html else ""


FIELDS = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]


def _measure(pages: pa.Array) -> dict[str, object]:
    texts = [main_text(html) for html in pages.to_pylist()]
    return {
        "text": pa.array(texts, pa.string()),
        "n_chars": pa.array([len(text) for text in texts], pa.int64()),
    }


def extract_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default but those named like the new ones), ``text``, ``n_chars``.

    Character references are decoded, white space inside a line becomes one space, lines are
    joined by an empty line in page order. Null, empty and text-free pages give an empty text.
    Unclosed elements end with their parents; markup cut off by the end of the page is dropped.
    Rows are independent, so repeated rows change nothing; an empty table gives an empty result.
    """
    if keep is None:
        keep = [name for name in pages.columns if name.lower() not in ("text", "n_chars")]
    return append_columns(pages, html, FIELDS, _measure, keep)
