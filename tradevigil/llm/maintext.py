"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block of the page. Blocks of menus, headers, footers,
adverts and the like become empty lines, and so do lines that are mostly links. The text
lengths of every `WINDOW` lines are summed; text begins where that sum surges over a fixed
number of characters and goes on, and ends where it dives to nothing. All lines in between
are kept. An element named as the article only adds weight to its lines.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: A surge needs so many characters, however long other lines are. Each character inside an
#: element that is named as the article counts so many times.
LEAST_CHARS, NAMED_WEIGHT = 40, 4
LINKED = 0.6  # share of a line's characters in links above which it is a menu, outside such elements

# Elements and name parts, fixed values of public mark-up practice.
RAW = "script style noscript template textarea iframe svg math object title select".split()
OUTSIDE = set("nav header footer aside form menu dialog button head".split())
MAIN = {"article", "main"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILER = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion related replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "topbar widget".split()
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"}

#: Names before another that say it is not there, or merely that the page has one.
ABSENT = set("no not non without hide hidden has with".split())
#: Kinds that never hold the article, however much text they have.
NEVER = set("comment comments disqus respond replies nav header footer menu aside".split())
#: Raw elements that may close themselves.
DRAWN = {"svg", "math"}

_START = re.compile(r"<(?:(?P<comment>!--)|(?P<end>/)?(?P<name>[a-zA-Z][\w:-]*)|[!?])")
_REST = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW}
_NAMED = re.compile(r"(?:^|\s)(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ROLE = re.compile(r"(?:^|\s)role\s*=\s*[\"']?([\w-]+)", re.I)
_PART = re.compile(r"[^a-z0-9]+")


class _Ends:
    """Where tags end: at the first `>` outside quotes. Linear in the page, also where quotes stay open."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.marks: list[int] | None = None

    def after(self, at: int) -> int:
        """The place after the end of a tag that is open at `at`; -1 if it has none."""
        if at > self.last:
            return -1
        if self.marks is None:
            if found := _REST.match(self.html, at):
                return found.end()
            self._index()
        i = bisect_left(self.marks, at)
        return self.ends[i]

    def _index(self) -> None:
        """The end for each quote or `>` that stands outside quotes, from the page's end back."""
        html = self.html
        self.marks = [m.start() for m in re.finditer("[\"'>]", html)]
        self.ends = [-1] * (len(self.marks) + 1)
        after: dict[str, int] = {}
        for i in range(len(self.marks) - 1, -1, -1):
            mark = html[self.marks[i]]
            if mark == ">":
                self.ends[i] = self.marks[i] + 1
            else:
                if mark in after:
                    self.ends[i] = self.ends[after[mark] + 1]
                after[mark] = i


def _tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start and past-the-last place of each piece of markup, with name, closing or not, and attributes.

    Comments, declarations and raw elements (with what they hold) have no name. An unclosed
    comment or raw element ends with the page; a tag that never ends is text.
    """
    ends, at = _Ends(html), html.find("<")
    while at >= 0:
        start = _START.match(html, at)
        past = -1
        if start and start["comment"]:
            past = html.find("-->", start.end())
            past = past + 3 if past >= 0 else len(html)
            yield at, past, "", False, ""
        elif start and not start["name"]:
            past = html.find(">", start.end()) + 1 if start.end() <= ends.last else -1
            if past > 0:
                yield at, past, "", False, ""
        elif start:
            past = ends.after(start.end())
            if past > 0:
                name, rest = start["name"].lower(), html[start.end() : past - 1]
                if name in _RAW_END and not start["end"] and not (name in DRAWN and rest.endswith("/")):
                    closed = _RAW_END[name].search(html, past)
                    past = closed.end() if closed else len(html)
                    yield at, past, "", False, ""
                else:
                    yield at, past, name, bool(start["end"]), rest
        at = html.find("<", past if past > 0 else at + 1)


def _boiler(name: str, rest: str, inside: bool) -> set[str]:
    """The names by which an element holds no article text; `inside`: it stands in the article."""
    if name in OUTSIDE and not (inside and name == "header"):
        return {name}
    if "=" not in rest or name in ("body", "html"):
        return set()
    if (role := _ROLE.search(rest)) and role[1].lower() in ROLES:
        return {role[1].lower()}
    found = set()
    for named in _NAMED.finditer(rest):
        for word in "".join(x or "" for x in named.groups()).lower().split():
            parts = _PART.split(word)
            if parts[0] not in ABSENT:
                found |= BOILER.intersection(parts)
    return found


def lines(html: str, spared: frozenset[int] = frozenset()) -> list[tuple[str, int, bool]]:
    """Text, characters in links, and whether it stands in a main element, of each block.

    Elements named like boilerplate are left out, but for those that hold more than half of the
    page's text (`spared`, by where they start; found on the way, and the page is then read
    again). Comments, menus, headers, footers and asides are never spared, nor is anything outside
    of a main element that has text.
    """
    out: list[tuple[str, int, bool]] = []
    stack: list[str] = []
    held: Counter[str] = Counter()
    text: list[str] = []
    linked, skipped, main, anchors = 0, 0, 0, 0  # the last three: depths in the stack, or 0
    total, in_main, mains = 0, 0, 0  # characters so far, those in main elements, how many of these are open
    named: dict[int, tuple[int, int, int]] = {}  # per depth of a named element: its start, `total` and `in_main` there
    sizes: list[tuple[int, int, int]] = []

    def flush() -> None:
        nonlocal linked
        joined = " ".join(unescape("".join(text)).split())
        out.append((joined, linked, main > 0))
        text.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal skipped, main, anchors, mains
        while len(stack) > depth:
            if len(stack) in named:
                start, before, main_before = named.pop(len(stack))
                sizes.append((start, total - before, in_main - main_before))
            name = stack.pop()
            held[name] -= 1
            mains -= name in MAIN
        skipped = skipped if skipped <= depth else 0
        main = main if main <= depth else 0
        anchors = anchors if anchors <= depth else 0

    def read(piece: str) -> None:
        nonlocal linked, total, in_main
        n = len(piece.strip())
        total += n
        in_main += n if mains else 0
        if not skipped:
            text.append(piece)
            if anchors:
                linked += len(" ".join(unescape(piece).split()))

    at = 0
    for start, past, name, ends, rest in _tags(html):
        if start > at:
            read(html[at:start])
        at = past
        if not name:
            continue
        if name not in INLINE:
            if not skipped or name in MAIN:
                flush()
        if ends:
            if held[name] > 0:
                depth = len(stack)
                while stack[depth - 1] != name:
                    depth -= 1
                close(depth - 1)
            continue
        if name in VOID or rest.endswith("/"):
            continue
        boiler = _boiler(name, rest, main > 0)
        if skipped and name in MAIN and stack[skipped - 1] in OUTSIDE and not boiler:
            close(skipped - 1)  # the menu or header before it was left open
        if name == "p" and stack and stack[-1] == "p":
            close(len(stack) - 1)
        stack.append(name)
        held[name] += 1
        mains += name in MAIN
        if boiler and not boiler & NEVER:
            named[len(stack)] = start, total, in_main
        if not skipped and boiler and start not in spared:
            skipped = len(stack)
        elif not skipped and not main and name in MAIN:
            main = len(stack)
        elif name == "a" and not anchors:
            anchors = len(stack)
    if at < len(html):
        read(html[at:])
    flush()
    close(0)
    large = frozenset(start for start, n, own in sizes if 2 * n > total and (own or not in_main))
    return lines(html, large) if large and not spared else out


def main_text(html: str | None) -> str:
    """The text between surge and dive points; empty if there is none."""
    # white space between blocks leaves lines without text: they are no gap, menus of links are
    found = [line for line in lines(html or "") if line[0]]
    lengths = [
        len(text) * NAMED_WEIGHT if main else 0 if linked > LINKED * len(text) else len(text) for text, linked, main in found
    ]
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    # where nothing surges there is no distribution to go by, and all lines are as good
    threshold = LEAST_CHARS if max(sums, default=0) >= LEAST_CHARS else 1
    kept, inside = [], False
    for i, (text, _, _) in enumerate(found):
        if not inside:
            inside = lengths[i] > 0 and sums[i] >= threshold
        elif not sums[i]:
            inside = False
        if inside and lengths[i]:
            kept.append(text)
    return " ".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `text` of each page, from its whole html.

    NULL or empty html gives an empty text; broken markup is read as far as it goes: an
    unclosed comment or script ends with the page. Repeated rows each get a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(html.as_py()) for html in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")


def report(pages: DataFrame) -> DataFrame:
    """The columns of `op7_main_text`."""
    return extracted(pages).withColumn("n_chars", F.length("text").cast("bigint"))
