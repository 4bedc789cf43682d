"""Main text of web pages by text-to-tag ratio.

The page is read as a stream of parser events.  Lines are the pieces of text between block
boundaries; a line's ratio is its characters over the tags it took, on a logarithmic scale.
The ratios are smoothed with a Gaussian along the page, so that a short paragraph between
long ones keeps their company.  Marks are evidence, not verdicts: a line inside an article
or main element counts ``PRIOR`` more, one in a menu, advert or the like as much less.  A
threshold splits the lines into two clusters, and the regions that hold lines of the upper one are the
content: marked regions, and for text outside those every container with a line that is in the
upper cluster by its own ratio, and what lies between them in that cluster.  Chosen regions and
containers are returned whole.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments
are known by element, role, or words of their class and id, and are never content; inside
an article or main element only by names made of such words alone, so that a "search-results"
or "related-work" there is text.  Words after "no", "has" and the like say what a part lacks
or holds, not what it is.  An article inside a sidebar or comments is left out unless it is
longer than the text outside.

A null or empty page has an empty text, as has a page of nothing but such parts.  Repeated
rows are read each by itself, long pages whole; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import rows_with

#: Width of the smoothing, in lines, and how many lines it reaches to either side.
SIGMA = 1.0
REACH = 3
#: What a mark for or against a line counts, on the scale of the ratios' logarithm.
PRIOR = 2.0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img".split())
SKIPPED = frozenset(
    "head title script style noscript template nav aside footer form button select textarea iframe svg canvas menu dialog "
    "audio video datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent "
    "gdpr notice notices notification popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside "
    "footer comment comments disqus respond share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login search pagination pager widget widgets toolbar copyright skip".split())
#: Words that say nothing of their own beside one of those.
FILLERS = frozenset("area bar block box button buttons container footer group inner item items link links list message panel row section slot text unit wrap wrapper".split())
#: Parts inside which an article element is a card or a comment, not the page's article.
KEPT_OUT = frozenset("aside comment comments disqus respond related recommended recommendations sidebar widget widgets".split())
REGIONS = frozenset(("article", "main"))
#: After one of these, a class name speaks of other parts.
MODIFIERS = frozenset("no not non without with has have hide".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: An element of one of these is closed by the next one of the same kind.
CLOSED_BY_NEXT = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                  "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class _Reader(HTMLParser):
    """Lines of a page: text, tags, whether it is skipped, region and container."""

    def __init__(self, rescue: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.rescue, self.left_out = rescue, False
        self.open: list[tuple[str, bool, bool, int, int]] = []  # tag, skipped, kept out, region, container
        self.lines: list[tuple[str, int, bool, int, int]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.made = 0

    def _state(self) -> tuple[bool, bool, int, int]:
        return self.open[-1][1:] if self.open else (False, False, 0, 0)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            skipped, _, region, container = self._state()
            self.lines.append((text, self.tags, skipped, region, container))
            self.tags = 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in CLOSED_BY_NEXT or (tag not in INLINE and self.open and self.open[-1][0] == "p"):
            self._close_open(tag)
        if tag in REGIONS or tag == "body":
            self._leave_unclosed(tag)
        skipped, out, region, container = self._state()
        values = {k: v or "" for k, v in attrs}
        role = values.get("role", "").lower()
        names = [_own_words(name) for k in ("class", "id") for name in values.get(k, "").split()]
        words = {w for name in names for w in name}
        if tag not in ("html", "body", "main"):
            marked = any(_is_chrome(name) for name in names) if region else words & NAMES
            if tag == "header" or "header" in words or "masthead" in words:
                marked = marked or not region
            hidden = "hidden" in values or "display:none" in values.get("style", "").replace(" ", "").lower()
            skipped = skipped or tag in SKIPPED or role in ROLES or bool(marked) or hidden
            out = out or tag == "aside" or bool(words & KEPT_OUT)
        self.made += 1
        if not region and not skipped and (tag in REGIONS or role in ("main", "article") or values.get("itemprop") == "articleBody"):
            region = self.made
        if tag not in INLINE and tag not in ("p", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dl", "dt", "dd"):
            container = self.made
        self.open.append((tag, skipped, out, region, container))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break
            if tag in INLINE and self.open[i][0] not in INLINE:
                break  # an inline end tag closes nothing beyond its block

    def handle_data(self, data):
        self.parts.append(data)

    def _close_open(self, tag: str) -> None:
        """A new block ends an open paragraph, a new item the open item of its list."""
        ends = CLOSED_BY_NEXT.get(tag, ())
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == "p" or name in ends:
                del self.open[i:]
                return
            if name not in INLINE:
                return

    def _leave_unclosed(self, tag: str) -> None:
        """An article that begins inside an unclosed menu, advert or notice is not part of it, nor is a main element of anything."""
        for i, (_, skipped, out, _, _) in enumerate(self.open):
            if skipped and (not out or self.rescue or tag == "main"):
                del self.open[i:]
                return
            self.left_out = self.left_out or skipped


def _own_words(name: str) -> list[str]:
    """The words of a class name or id, up to one after which it speaks of other parts."""
    words = [w.lower() for w in _WORDS.findall(name)]
    return words[: next((i for i, w in enumerate(words) if w in MODIFIERS), len(words))]


def _is_chrome(words: list[str]) -> bool:
    """Whether a name is made of such words alone."""
    return any(w in NAMES for w in words) and all(w in NAMES or w in FILLERS for w in words)


def _open_text(lines: list[tuple[str, int, bool, int, int]], marked: bool = False) -> int:
    return sum(len(x[0]) for x in lines if not x[2] and (x[3] or not marked))


def read_lines(html: str) -> list[tuple[str, int, bool, int, int]]:
    lines, left_out = _read(html, False)
    if left_out and not _open_text(lines, True):
        rescued, _ = _read(html, True)
        if _open_text(rescued, True) > _open_text(lines):
            return rescued
    return lines


def _read(html: str, rescue: bool) -> tuple[list[tuple[str, int, bool, int, int]], bool]:
    tail = html.rfind("<")
    if tail >= 0 and ">" not in html[tail:] and re.match(r"<[/!?a-zA-Z]", html[tail:]):
        html = html[:tail]  # the page breaks off inside a tag
    reader = _Reader(rescue)
    try:
        reader.feed(html)
        reader.close()
    except AssertionError:  # an unknown marked section; its opening is then read as a comment
        reader = _Reader(rescue)
        reader.feed(html.replace("<![", "<!-["))
        reader.close()
    reader.flush()
    return reader.lines, reader.left_out


def ratios(length: np.ndarray, tags: np.ndarray) -> np.ndarray:
    return np.log1p(length / tags)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    steps = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-steps**2 / (2 * SIGMA**2))
    padded = np.pad(ratios, REACH, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """The border between two clusters of values: halfway between their means, by repeated assignment."""
    border = float(values.mean())
    for _ in range(50):
        low, high = values[values < border], values[values >= border]
        if not len(low) or not len(high):
            break
        moved = float(low.mean() + high.mean()) / 2
        if abs(moved - border) < 1e-9:
            break
        border = moved
    return border


def main_text(html: str | None) -> str:
    lines = read_lines(html or "")
    if not lines:
        return ""
    length = np.array([len(x[0]) for x in lines], float)
    tags = np.array([max(1, x[1]) for x in lines], float)
    open_lines = np.array([not x[2] for x in lines])
    if not open_lines.any():
        return ""
    region, container = np.array([x[3] for x in lines]), np.array([x[4] for x in lines])
    own = ratios(length, tags)
    marks = np.where(open_lines, np.where(region > 0, PRIOR, 0.0), -PRIOR)
    evidence = smoothed(own) + marks
    border = threshold(evidence)
    content = open_lines & (evidence >= border)
    if not content.any():
        content = open_lines
    marked = open_lines & (region > 0)
    picked = marked & np.isin(region, np.unique(region[content & marked]))
    # Outside of marks a container is chosen by a line's own ratio, not only by the company of other lines.
    strong = content & ~marked & (own + marks >= border)
    strong = strong if strong.any() or picked.any() else content & ~marked
    if strong.any():
        inside = np.flatnonzero(strong)
        between = np.zeros(len(lines), bool)
        between[inside[0]: inside[-1] + 1] = content[inside[0]: inside[-1] + 1]
        for c in np.unique(container[strong]):
            inside = np.flatnonzero(content & ~marked & (container == c))
            between[inside[0]: inside[-1] + 1] = True
        picked |= open_lines & ~marked & (between | np.isin(container, np.unique(container[strong])))
    return " ".join(x[0] for x, keep in zip(lines, picked, strict=True) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row."""
    rows = rows_with(pages, page_id=id_col, url=url_col, html=html_col).withColumn("html", F.col("html").cast("string"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
