"""Pages as a flat table of elements: a row each, with its parent, the end of its subtree and its words.

Rows stand in document order, so that a subtree is a range of rows, what an
element inherits or holds is a running sum, and an element's text is a slice of
its page's words. Rules over whole blocks of pages are then array operations.
"""

from __future__ import annotations

from collections.abc import Iterable
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import numpy as np
import pandas as pd

VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
#: An opening tag ends an open one of these in the same container.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    **dict.fromkeys("p div ul ol table section article aside nav header footer main form h1 h2 h3 h4 h5 h6 blockquote pre hr dl figure".split(), {"p"}),
}
CONTAINERS = frozenset("ul ol dl table section article aside nav header footer main div body html".split())
INVISIBLE = frozenset("script style noscript svg template".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5")


class _Rows(HTMLParser):
    """Append the elements of pages to one table, whatever the pages' errors."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.up: list[int] = []
        self.last: list[int] = []
        self.begin: list[int] = []
        self.end: list[int] = []
        self.own: list[int] = []
        self.page: list[int] = []
        self.words: list[str] = []
        self.holder: list[int] = []
        self.raw: dict[int, str] = {}
        self.open: list[int] = []
        self.unseen = 0

    def one(self, page: int, html: str) -> None:
        self.reset()
        self.number, self.once = page, set()
        self.enter("#root", {})
        self.feed(html)
        self.close()
        while self.open:
            self.leave()

    def enter(self, tag: str, attrs: dict[str, str]) -> None:
        row = len(self.tag)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.up.append(self.open[-1] if self.open else -1)
        self.page.append(self.number)
        for column, value in ((self.last, row), (self.begin, len(self.words)), (self.end, len(self.words)), (self.own, -1)):
            column.append(value)
        self.open.append(row)
        self.unseen += tag in INVISIBLE

    def leave(self) -> None:
        row = self.open.pop()
        self.last[row], self.end[row] = len(self.tag) - 1, len(self.words)
        self.unseen -= self.tag[row] in INVISIBLE

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            if tag in self.once:
                return
            self.once.add(tag)
        ended = ENDED_BY.get(tag, ())
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[depth]]
            if name in ended:
                while len(self.open) > depth:
                    self.leave()
            if name in ended or name in CONTAINERS:
                break
        self.enter(tag, {k: v or "" for k, v in reversed(attrs)})
        if tag in VOID:
            self.leave()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        deep = len(self.open)
        self.handle_starttag(tag, attrs)
        if tag not in VOID and len(self.open) > 1 and self.tag[self.open[-1]] == tag and len(self.open) >= deep:
            self.leave()

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                while len(self.open) > depth:
                    self.leave()
                break

    def handle_data(self, data: str) -> None:
        row = self.open[-1]
        if self.unseen:
            self.raw[row] = self.raw.get(row, "") + data
        else:
            self.own[row] += len(data.strip()) + 1
            words = data.split()
            self.words += words
            self.holder += [row] * len(words)


class Elements:
    """The elements of a block of pages as aligned arrays; row numbers run over the whole block.

    ``first[k]`` is the root row of page k, ``body[k]`` its body (or root);
    ``chars`` is the length of an element's visible text and ``own`` that of the
    text that stands directly in it.
    """

    def __init__(self, pages: Iterable[str | None]) -> None:
        rows = _Rows()
        starts = []
        for k, html in enumerate(pages):
            starts.append(len(rows.tag))
            rows.one(k, html or "")
        self.attrs, self.words, self.raw = rows.attrs, rows.words, rows.raw
        self.tag = np.array(rows.tag, object)
        self.up, self.last, self.begin, self.end, self.page = (np.array(x, np.int64) for x in (rows.up, rows.last, rows.begin, rows.end, rows.page))
        #: The row in which each word stands.
        self.holder = np.array(rows.holder, np.int64)
        self.own = np.maximum(np.array(rows.own, np.int64), 0)
        self.first = np.array(starts, np.int64)
        sizes = np.concatenate([[0], np.cumsum(np.fromiter((len(w) + 1 for w in self.words), np.int64, len(self.words)))])
        self.chars = np.maximum(sizes[self.end] - sizes[self.begin] - 1, 0)
        self.hidden = self.at_or_above(self.has_tag(*INVISIBLE))
        bodies = np.flatnonzero(self.has_tag("body"))
        self.body = self.first.copy()
        self.body[self.page[bodies]] = bodies
        self.classes = [a.get("class", "").split() for a in self.attrs]

    def __len__(self) -> int:
        return len(self.tag)

    def has_tag(self, *tags: str) -> np.ndarray:
        return np.isin(self.tag, tags) if len(self.tag) else np.zeros(0, bool)

    def where(self, test) -> np.ndarray:
        """Return which rows' attributes pass a test of (classes as one string, attributes)."""
        return np.fromiter((bool(test(" ".join(c), a)) for c, a in zip(self.classes, self.attrs, strict=True)), bool, len(self))

    def at_or_above(self, marked: np.ndarray) -> np.ndarray:
        """Return whether a row or one of those above it is marked."""
        return self.depth(marked) > 0

    def depth(self, marked: np.ndarray) -> np.ndarray:
        """Return how many of a row and those above it are marked."""
        step = np.zeros(len(self) + 1, np.int64)
        rows = np.flatnonzero(marked)
        np.add.at(step, rows, 1)
        np.add.at(step, self.last[rows] + 1, -1)
        return np.cumsum(step)[:-1]

    def below(self, weight: np.ndarray) -> np.ndarray:
        """Return the sum of a weight over the rows strictly below each row."""
        sums = np.concatenate([[0], np.cumsum(weight)])
        return sums[self.last + 1] - sums[np.arange(len(self)) + 1]

    def text(self, row: int) -> str:
        """Return the visible text of a row with single spaces; that of an invisible row is what stands in it."""
        return " ".join(self.words[self.begin[row] : self.end[row]])

    def rows_of(self, page: int) -> range:
        return range(int(self.first[page]), int(self.last[self.first[page]]) + 1)

    def anchors(self, urls: list[str]) -> pd.DataFrame:
        """Return a row for each ``a`` with a target: row, page, href, label, to (absolute), host, path, fragment."""
        at = np.array([k for k in np.flatnonzero(self.has_tag("a")) if "href" in self.attrs[k]], np.int64)
        found = pd.DataFrame({"row": at, "page": self.page[at] if len(at) else at})
        found["href"] = pd.Series([self.attrs[k]["href"].strip() for k in at], dtype=str, index=found.index)
        found["label"] = pd.Series([self.text(k) for k in at], dtype=str, index=found.index)
        cache: dict[tuple[int, str], tuple[str, str, str, str]] = {}
        for key in zip(found["page"], found["href"], strict=True):
            if key not in cache:
                cache[key] = _target(urls[key[0]], key[1])
        split = [cache[key] for key in zip(found["page"], found["href"], strict=True)]
        for k, name in enumerate(("to", "host", "path", "fragment")):
            found[name] = pd.Series([s[k] for s in split], dtype=str, index=found.index)
        return found


def _target(base: str, href: str) -> tuple[str, str, str, str]:
    try:
        to = urljoin(base, href)
        parts = urlsplit(to)
    except ValueError:  # no URL at all, such as an unfinished address in brackets
        return "", "", "", ""
    return to, bare_host(parts.netloc), parts.path, parts.fragment


def bare_host(netloc: str) -> str:
    return netloc.lower().removeprefix("www.")
