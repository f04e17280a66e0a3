"""Main text of web pages by text-to-tag ratios over parser events.

The standard library's parser streams a page's events. Text is gathered into lines that end at block-level
tags; each line's ratio is its characters over the tags met in it. Lines below elements that are never
article text (footers, scripts, ...), or whose class or id names reader comments, adverts, menus and the like, are set
apart. Forms, menus without an end and elements whose name may also stand for something else (`reader`, `widget`, a part of a longer
name as in `with-sidebar`) are doubtful; a part of a name counts on blocks only, not on a paragraph, heading or span.
The ratios of the rest are smoothed by a Gaussian and split in two clusters by a threshold (the mean of the
clusters' means, repeated until it stands still). Lines of the upper cluster vote with their characters for all
containers they lie in. A doubtful element without most of the votes is set apart, too, and the rest votes again. The
smallest container with nearly all votes is the article, and all its lines are its text, so
that short paragraphs between long ones stay. Tags don't vote: an article or main element around the smallest container
is taken in its place only if it holds little besides. A menu or other side part that isn't closed ends where the main
element starts, a menu also where an article does.

Character references are decoded, white space inside a line is one space, lines are joined by one space.

Each page is a row for itself: no shuffle, memory for one batch of pages. Defined results: null or empty html
and pages without text give an empty text; repeated pages each get a row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose text is never article text.
APART = frozenset("""head title script style noscript template footer aside button select textarea option dialog menu
    iframe object canvas svg audio video""".split())
#: Elements that are article text only if they hold most of it: a form around the page, a menu that is never closed.
DOUBTFUL = frozenset(["form", "nav"])
#: The same outside of an article.
APART_OUTSIDE = frozenset(["header"])
#: Elements that end a line.
BLOCKS = frozenset("""address article aside blockquote body br button canvas caption center col dd details dialog div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav object ol optgroup option p pre section
    select summary table tbody td template textarea tfoot th thead title tr ul video""".split())
#: Elements that can hold an article.
CONTAINERS = frozenset("html body main article section div table td center".split())
#: Elements on which a part of a longer name counts.
NAMED = CONTAINERS | frozenset("form nav ul ol dl fieldset figure header tr".split())
#: Elements that end where one of these starts.
ENDED_BY = {"main": frozenset(["nav", "aside", "header", "footer"]), "article": frozenset(["nav"])}
#: The share of the upper cluster's characters that the article's container has at least.
NEARLY_ALL = 0.9
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that set an element apart.
NAMES = frozenset("""ad ads adbox advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies
    copyright disclaimer discussion disqus footer gdpr masthead menu nav navbar navigation newsletter notice notices notification pager pagination
    popup promo promoted recommended related replies reply responses share sharing sidebar signup social sponsor sponsored subscribe
    toolbar topbar widget complementary contentinfo reader alert""".split())
#: Those of them that stand for other things, too.
UNSURE = frozenset("alert banner complementary disclaimer discussion notice promo promoted reader recommended sponsored toolbar widget".split())
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _set_apart(attributes: list[tuple[str, str | None]]) -> tuple[bool, bool, bool]:
    """Whether a name or attribute sets the element apart, whether a whole name makes it doubtful, and whether a part of
    a longer one does, as in `with-sidebar`."""
    unsure = part = False
    for key, value in attributes:
        if value and key in ("class", "id", "role"):
            for name in value.split():
                words = _NAME.findall(_CAMEL.sub(" ", name).lower())
                if NAMES.isdisjoint(words):
                    continue
                if len(words) > 1:
                    part = True
                elif words[0] in UNSURE:
                    unsure = True
                else:
                    return True, False, False
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True, False, False
    return False, unsure, part


class _Lines(HTMLParser):
    """Lines of a page: text, number of tags, containers they lie in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.tags = self.apart = self.articles = 0
        self.open: list[tuple[str, bool, int]] = []
        self.containers: list[int] = [0]
        self.parents: list[int] = [-1]
        self.kinds: list[str] = ["page"]
        self.doubtful: list[int] = []
        #: Open menus and the number of lines before each: with its end tag a menu's lines go.
        self.menus: dict[int, int] = {}
        self.lines: list[tuple[str, int, int]] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text and not self.apart:
            self.lines.append((text, self.tags, self.containers[-1]))
        if self.parts:
            self.parts, self.tags = [], 0

    def handle_starttag(self, tag, attributes):
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in ENDED_BY:
            self.close_before(ENDED_BY[tag])
        apart = tag in APART or tag in APART_OUTSIDE and not self.articles
        maybe = tag in DOUBTFUL
        if not apart and attributes and tag not in ("html", "body", "main"):
            apart, unsure, part = _set_apart(attributes)
            maybe = maybe or unsure or part and tag in NAMED
            if apart and tag == "article":
                apart, maybe = False, True
        if not (apart or maybe) and tag not in CONTAINERS:
            return
        own = -1
        if maybe or tag in CONTAINERS:
            own = len(self.parents)
            self.parents.append(self.containers[-1])
            self.kinds.append("apart" if apart else tag)
            if maybe and not apart:
                self.doubtful.append(own)
                if tag == "nav":
                    self.menus[own] = len(self.lines)
            if tag not in BLOCKS:  # what may be set apart is a line for itself
                self.end_line()
            self.containers.append(own)
        self.open.append((tag, apart, own))
        self.apart += apart
        self.articles += tag == "article"

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if any(x[0] == tag for x in self.open):
            while self.open[-1][0] != tag:
                self.close_last()
            menu = self.open[-1][2] if tag == "nav" else -1
            self.close_last()
            if menu in self.menus:
                first = self.menus.pop(menu)
                self.tags += sum(tags for _, tags, _ in self.lines[first:])
                del self.lines[first:]

    def close_last(self) -> None:
        name, apart, own = self.open.pop()
        if own >= 0:
            if name not in BLOCKS:
                self.end_line()
            self.containers.pop()
        self.apart -= apart
        self.articles -= name == "article"

    def close_before(self, kinds: frozenset[str]) -> None:
        """Closes side parts that were left open, with all that is open in them."""
        first = next((i for i, x in enumerate(self.open) if x[0] in kinds), len(self.open))
        while len(self.open) > first:
            self.close_last()

    def handle_startendtag(self, tag, attributes):
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1

    def handle_data(self, data):
        if not self.apart:
            self.parts.append(data)


def upper_cluster(page: _Lines, sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the lines, and which lines are of the upper cluster of smoothed ratios."""
    size = np.array([len(text) for text, _, _ in page.lines], float)
    ratio = smoothed(size / np.maximum([tags for _, tags, _ in page.lines], 1), sigma)
    return size, ratio >= threshold(ratio)


def summed(page: _Lines, values: np.ndarray) -> np.ndarray:
    """The sum of the lines' values for every container, those in it included."""
    total = np.zeros(len(page.parents))
    np.add.at(total, [own for _, _, own in page.lines], values)
    for i in range(len(total) - 1, 0, -1):  # parents come first
        total[page.parents[i]] += total[i]
    return total


def without_doubtful(page: _Lines, sigma: float) -> None:
    """Takes away the lines of doubtful elements, but for those that hold most of the votes."""
    if not page.lines:
        return
    size, upper = upper_cluster(page, sigma)
    votes = summed(page, size * upper)
    gone = [False] * len(page.parents)
    doubtful = set(page.doubtful)
    for i, up in enumerate(page.parents):
        gone[i] = up >= 0 and gone[up] or i in doubtful and 2 * votes[i] <= votes[0]
    lines, before = [], 0
    for text, tags, own in page.lines:
        if gone[own]:
            before += tags
        else:
            lines.append((text, tags + before, own))
            before = 0
    page.lines = lines


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), "valid")


def threshold(values: np.ndarray) -> float:
    """Between two clusters of values; the least value if there is only one."""
    at = values.mean()
    for _ in range(50):
        low, high = values[values < at], values[values >= at]
        if not len(low):
            return float(values.min())
        new = (low.mean() + high.mean()) / 2
        if new == at:
            break
        at = new
    # Two clusters that lie near each other are one: of few lines alike, none is left out.
    if values[values < at].mean() > 0.5 * values[values >= at].mean():
        return float(values.min())
    return float(at)


def main_text(html: str, sigma: float = 1.0) -> str:
    page = _Lines()
    page.feed(html)
    page.close()
    page.end_line()
    if page.doubtful:
        without_doubtful(page, sigma)
    if not page.lines:
        return ""
    size, upper = upper_cluster(page, sigma)
    votes, inside = summed(page, size * upper), summed(page, size)
    # Containers with nearly all votes lie one in another, and later ones deeper.
    best = int(np.flatnonzero(votes >= NEARLY_ALL * votes[0])[-1])
    # A parent with little besides, such as a title, belongs to it; an article or main element may have somewhat more.
    up = best
    while (up := page.parents[up]) >= 0 and page.kinds[up] not in ("html", "body", "page", "nav"):
        if inside[up] <= (1.5 if page.kinds[up] in ("article", "main") else 1.3) * inside[best]:
            best = up
    below = np.zeros(len(page.parents), bool)
    for i, up in enumerate(page.parents):  # parents come first
        below[i] = i == best or up >= 0 and below[up]
    return " ".join(text for text, _, own in page.lines if below[own])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                found = [main_text(x) if x else "" for x in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    given = pages.select("page_id", F.col("url").cast("string").alias("url"), "html")
    return given.mapInArrow(texts, f"page_id {given.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
