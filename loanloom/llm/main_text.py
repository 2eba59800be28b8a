"""Main text of web pages by line-block distribution.

A page is stripped to lines, one per block of text, without markup, scripts and
the containers that pages set apart as something else (menus, adverts, forms,
comments). Each line weighs as many characters as it has outside links. The
sums of `WINDOW` lines in a row rise where running text begins (the surge) and
fall to nothing where it ends (the dive); the lines between the two are kept.
Pages are handled one by one within Arrow batches and never shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.text import steps

#: Lines in one sum.
WINDOW = 3
#: A run of lines is text if some window in it has so many characters, or this share of the page's greatest.
LEAST_PEAK, PEAK_SHARE = 86, 0.25
#: The first and last line of a run outside a landmark have so many characters, end a sentence, or are a heading.
LEAST_EDGE = 25

# --- markup -----------------------------------------------------------------

#: Elements whose content is no text at all; they end at their own closing tag.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "object", "svg", "math", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are part of a line; every other tag ends one.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
LANDMARKS = frozenset(("article", "main"))
#: Elements that are never part of an article.
ASIDE = frozenset("head nav aside footer form button select menu dialog input audio video canvas".split())
#: Their part of the page is told by the role attribute.
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of a class name or id that set a container apart from the article.
SIGNS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert newsletter subscribe subscription signup login nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar widget widgets related recommended recommendations share sharing social comment "
    "comments commentlist respond reply replies discussion disqus footer masthead topbar toolbar popup modal overlay "
    "pagination pager copyright disclaimer".split()
)
#: Words before or after a sign that turn it into a remark on the layout.
LAYOUT = frozenset("has with without no is layout page body wrapper wrap container".split())

_TOKEN = re.compile(
    r"""<!--(?:[^-]++|-(?!->))*+(?:-->|\Z)"""
    r"""|<(?P<raw>%s)\b(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^'">])*+(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^'">])*+)(?:>|\Z)"""
    r"""|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)""" % "|".join(RAW),
    re.IGNORECASE,
)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.IGNORECASE) for name in RAW}
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?![\w-])\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_INVISIBLE = re.compile(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", re.IGNORECASE)


def signed(names: str) -> frozenset[str]:
    """The signs by which one of the class names sets its element apart."""
    for name in names.split():
        words = [w.lower() for w in _PARTS.findall(name)]
        if words and not LAYOUT & set(words) and (words[0] in SIGNS or words[-1] in SIGNS):
            return SIGNS & {words[0], words[-1]}
    return frozenset()


@dataclass
class Element:
    """An open or closed element; ``end`` is the number of the line after its last."""

    name: str
    start: int
    #: Whether an article or main element holds it.
    inside: bool = False
    #: Set apart by its name, role or visibility, or only by a class name or id.
    apart: bool = False
    hinted: bool = False
    comments: bool = False
    #: How many landmarks had begun before it, and before its end.
    landmarks: tuple[int, int] = (0, 0)
    closed: bool = False
    end: int = -1


@dataclass
class Line:
    text: str
    #: Characters outside links, and all of them.
    plain: int
    size: int
    heading: bool


def _element(name: str, rest: str, start: int) -> Element:
    found = Element(name, start, apart=name in ASIDE)
    if not rest:
        return found
    for m in _ATTRIBUTE.finditer(rest):
        key = m.group(1).lower()
        value = m.group(2) or m.group(3) or m.group(4) or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _INVISIBLE.search(value)):
            found.apart = True
        elif key == "role":
            found.apart |= value.lower() in ROLES
            if value.lower() in LANDMARKS:
                found.name = "main" if name not in LANDMARKS else name
        elif key in ("class", "id"):
            signs = signed(value)
            found.hinted |= bool(signs)
            found.comments |= bool(signs & {"comment", "comments", "commentlist", "respond", "reply", "replies", "discussion", "disqus"})
    return found


class Page:
    """The lines of a page, and the elements that hold them."""

    def __init__(self, source: str):
        self.lines: list[Line] = []
        self.elements: list[Element] = []
        self._open: list[Element] = []
        self._names: Counter[str] = Counter()
        #: The lines where landmarks begin, in order.
        self._landmarks: list[int] = []
        self._pieces: list[tuple[str, bool]] = []
        self._links = 0
        at = 0
        while (m := _TOKEN.search(source, at)) is not None:
            self._text(source[at : m.start()])
            at = m.end()
            if m["raw"]:
                end = _RAW_END[m["raw"].lower()].search(source, at)
                at = end.end() if end else len(source)
            elif m["name"]:
                self._tag(m["name"].lower(), bool(m["end"]), m["rest"])
        self._text(source[at:])
        self._break()
        self._pop_to(0, False)

    def _text(self, piece: str) -> None:
        if piece:
            self._pieces.append((piece, self._links > 0))

    def _break(self) -> None:
        """The pieces since the last block tag become a line, unless they are blank."""
        if not self._pieces:
            return
        text = " ".join(html.unescape("".join(p for p, _ in self._pieces)).split())
        if text:
            linked = sum(len("".join(html.unescape(p).split())) for p, inside in self._pieces if inside)
            size = len(text) - text.count(" ")
            heading = any(self._names[h] for h in HEADINGS)
            self.lines.append(Line(text, max(0, size - linked), size, heading))
        self._pieces = []

    def _push(self, element: Element) -> None:
        element.inside = any(self._names[n] for n in LANDMARKS)
        element.landmarks = (len(self._landmarks), len(self._landmarks))
        self._open.append(element)
        self._names[element.name] += 1
        self.elements.append(element)

    def _pop_to(self, k: int, closed: bool = True) -> None:
        """Closes the open elements from number k up; only the first may have its own tag."""
        while len(self._open) > k:
            gone = self._open.pop()
            self._names[gone.name] -= 1
            gone.end, gone.closed = len(self.lines), closed and len(self._open) == k
            gone.landmarks = (gone.landmarks[0], len(self._landmarks))

    def _tag(self, name: str, end: bool, rest: str) -> None:
        if name in INLINE:
            if name == "a":
                self._links = 0 if end else 1
            if name == "br":
                self._pieces.append((" ", self._links > 0))
            if end or name in VOID or not rest or not (found := _element(name, rest, len(self.lines))).apart | found.hinted:
                return
            # An inline element that is set apart counts from the next line only if it begins one.
            if any(p.strip() for p, _ in self._pieces):
                return
            self._pieces = []
            self._push(found)
            return
        self._break()
        self._links = 0
        if end:
            if self._names[name]:
                k = len(self._open) - 1
                while self._open[k].name != name:
                    k -= 1
                self._pop_to(k)
            return
        if name in VOID:
            return
        # A paragraph or list item ends where the next block of its kind begins.
        for k in range(len(self._open) - 1, -1, -1):
            own = self._open[k].name
            if own == "p" or (own == name and name in ("li", "dt", "dd", "tr", "td", "th", "option")):
                self._pop_to(k)
                break
            if own not in INLINE and own not in HEADINGS:
                break
        element = _element(name, rest, len(self.lines))
        self._push(element)
        if element.name in LANDMARKS and not element.comments and not element.apart:
            element.landmarks = (len(self._landmarks) + 1, len(self._landmarks) + 1)
            self._landmarks.append(len(self.lines))

    def _removed(self) -> list[bool]:
        """For each line whether it stands in a container that is set apart."""
        change = [0] * (len(self.lines) + 1)
        for e in self.elements:
            end, around = e.end, e.landmarks[0] < e.landmarks[1]
            if around and not e.closed:
                end = self._landmarks[e.landmarks[0]]  # a container that nobody closed ends where the article begins
            elif around and e.hinted and not e.apart and not e.comments:
                continue  # a wrapper of the article
            # The header of the page, not the one of the article.
            header = e.name == "header" and not e.inside
            if (e.apart or header or (e.hinted and e.name not in ("html", "body"))) and end > e.start:
                change[e.start] += 1
                change[end] -= 1
        out, depth = [], 0
        for c in change[:-1]:
            depth += c
            out.append(depth > 0)
        return out

    def blocks(self) -> list[tuple[Line, bool]]:
        """The lines that are left after stripping, and whether each is in a landmark."""
        removed = self._removed()
        inside = [False] * len(self.lines)
        for e in self.elements:
            if e.name in LANDMARKS and not e.comments and not e.apart and not e.hinted:
                inside[e.start : e.end] = [True] * (e.end - e.start)
        if any(i and not r for i, r in zip(inside, removed, strict=True)):
            narrow = [False] * len(self.lines)
            for e in self.elements:  # an article within <main> is narrower than <main>
                if e.name == "article" and not e.comments and not e.apart and not e.hinted:
                    narrow[e.start : e.end] = [True] * (e.end - e.start)
            if any(i and not r for i, r in zip(narrow, removed, strict=True)):
                inside = narrow
        return [(line, i) for line, i, r in zip(self.lines, inside, removed, strict=True) if not r]


# --- the distribution -------------------------------------------------------


def weights(blocks: list[tuple[Line, bool]]) -> list[int]:
    """Characters that count towards running text, line by line.

    If a page marks its article, lines outside count nothing, and those inside
    count in full. Otherwise links do not count, nor does a line mostly of links.
    """
    marked = any(inside for _, inside in blocks)
    if marked:
        return [line.size if inside else 0 for line, inside in blocks]
    return [line.plain if 2 * line.plain > line.size else 0 for line, _ in blocks]


def runs(weight: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """First and past-the-last line of each stretch between a surge and its dive.

    The sum at a line is that of the ``window`` lines from it on. It surges at
    the first line of a stretch without an empty sum, and dives where a sum is empty
    again. A stretch counts if its greatest sum reaches `LEAST_PEAK` or
    `PEAK_SHARE` of the page's greatest; empty lines at its ends do not belong to it.
    """
    sums = [sum(weight[i : i + window]) for i in range(len(weight))]
    least = min(LEAST_PEAK, PEAK_SHARE * max(sums, default=0))
    found, start = [], None
    for i, s in enumerate([*sums, 0]):
        if s and start is None:
            start = i
        elif not s and start is not None:
            a, b = start, i
            while a < b and not weight[a]:
                a += 1
            while b > a and not weight[b - 1]:
                b -= 1
            if b > a and max(sums[a:b]) >= least:
                found.append((a, b))
            start = None
    return found


def main_text(source: str | None) -> str:
    """The kept lines of a page, joined by line ends; empty for null or blank pages."""
    if not source:
        return ""
    blocks = Page(source).blocks()
    kept = []
    for a, b in runs(weights(blocks)):
        if not any(inside for _, inside in blocks[a:b]):
            edge = [k for k in range(a, b) if _is_edge(blocks[k][0])]
            a, b = (edge[0], edge[-1] + 1) if edge else (a, b)
        kept += [line.text for line, _ in blocks[a:b]]
    return "\n".join(kept)


def _is_edge(line: Line) -> bool:
    return line.heading or line.size >= LEAST_EDGE or line.text.rstrip("\"'”’»)")[-1:] in (".", "!", "?", "…", "。")


# --- the table --------------------------------------------------------------


def _extract(batches: Iterator[pa.RecordBatch], keep: list[str], prefix: str) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "__html"):
        texts = [main_text(source) for source in batch.column("__html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in range(len(keep))] + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=[*keep, f"{prefix}text", f"{prefix}n_chars"],
        )


def extract(pages: DataFrame, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` of every page with its main ``text`` and that text's code points ``n_chars``.

    Null and empty pages, and pages without text, give an empty text; a page without
    markup is one line. Repeated pages give a row each, an empty table none. Tags
    that are never closed end as browsers end them, a script or comment at the end
    of the page. Pages of any length are read whole. Extra columns play no
    part; where kept ones are called like the results, ``prefix`` sets the results apart.
    """
    slim = pages.select(*keep, F.col("html").alias("__html"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields)
    return slim.mapInArrow(lambda b: _extract(b, keep, prefix), f"{kept}, `{prefix}text` string, `{prefix}n_chars` long")
