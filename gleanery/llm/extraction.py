"""HTML extraction by nearest-URL page differencing.

Pages of a host are ordered by URL path, and each is paired with the neighbour whose path shares more leading segments. Text
lines of both are aligned by longest common subsequence, and what they share is boilerplate and deleted. A line is the text of
a block; markup, scripts, styles, forms and what marks itself as menu, header, footer, sidebar, notice, advert or comments
never becomes one. Differencing decides on every page, with one exception: lines inside an article or main container are the
author's, as two pages may quote the same line or be copies of each other. Of the containers of a page (the outermost ones) it is
the one with most text that the neighbour lacks, and of equal ones with most text, whose shared lines are kept, unless the page
has more text of its own outside of all containers than all of that container is long: then it is a card beside the body.

Only hashes of lines are brought to the paired page. A null or empty html has an empty text. A page alone on its host, or without
a host, shares nothing. Of equal paths those with the nearer page_id are neighbours; repeated rows (same page_id and url) get the
same neighbour and are extracted each.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C
from gleanery.llm.neighbours import with_next
from gleanery.llm.urls import host, path

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=\"'/>]++)(?>\s*+=\s*+(?>\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav footer aside form script style noscript template svg math canvas select button textarea dialog iframe object audio video map menu title xmp noembed noframes datalist".split())
MAIN = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "head", "option", "legend"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS = {name: ("p", *others) for name, others in SIBLINGS.items()}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MARKS = frozenset(
    "nav navbar navigation menu masthead footer sidebar ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar comments comment commentlist replies reply disqus respond widget banner".split()
)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(raw)}


def _marked(name: str, raw: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element is to be dropped, and whether it is a main container."""
    if name in DROPPED or (name == "header" and not in_main):
        return True, False
    if not raw or raw.isspace():
        return False, name in MAIN
    a = _attributes(raw)
    role = a.get("role", "").lower()
    if role in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return name not in ("html", "body"), False
    if name not in ("html", "body") and name not in MAIN:
        parts = {p.lower() for p in NAME_PARTS.findall(a.get("class", "") + " " + a.get("id", ""))}
        if parts & MARKS or ("header" in parts and not in_main):
            return True, False
    elif name in MAIN and {p.lower() for p in NAME_PARTS.findall(a.get("class", "") + " " + a.get("id", ""))} & {"comment", "comments", "reply", "replies", "ad", "advert", "promo", "related"}:
        return True, False
    return False, name in MAIN or role in ("main", "article") or a.get("itemprop", "").lower() == "articlebody"


class _Open:
    """The elements that are open. Where the last one of a name stands is known without looking through them, so a tag costs the same however deep it lies.

    An inline element that is closed below others stays as a closed entry until it is on top."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int]] = []  # name ("" once closed), dropped, main: each with what it lies in
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, dropped: bool, main: int) -> None:
        self.at.setdefault(name, []).append(len(self.stack))
        if name in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((name, dropped, main))

    def last(self, names) -> int:
        """Place of the innermost open element of one of the names, or -1."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def outermost(self, names) -> int:
        return min((self.at[n][0] for n in names if self.at.get(n)), default=-1)

    def cut(self, i: int) -> None:
        """Close all from place i on."""
        while len(self.stack) > i:
            self._pop()
        self._tidy()

    def close(self, i: int) -> None:
        """Close the one at place i, the last of its name, alone."""
        name, dropped, main = self.stack[i]
        self.at[name].pop()
        if self.blocks and self.blocks[-1] == i:
            self.blocks.pop()
        self.stack[i] = ("", dropped, main)
        self._tidy()

    def _pop(self) -> None:
        name = self.stack.pop()[0]
        if name:
            self.at[name].pop()
            if self.blocks and self.blocks[-1] == len(self.stack):
                self.blocks.pop()

    def _tidy(self) -> None:
        while self.stack and not self.stack[-1][0]:
            self.stack.pop()

    @property
    def dropped(self) -> bool:
        return bool(self.stack) and self.stack[-1][1]

    @property
    def main(self) -> int:
        return self.stack[-1][2] if self.stack else 0


def lines(html: str) -> list[tuple[str, int]]:
    """Texts of the blocks in page order, each with the number of the outermost main container that it lies in, or 0."""
    out: list[tuple[str, int]] = []
    open_ = _Open()
    text: list[str] = []
    containers = 0
    at = 0

    def flush() -> None:
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if line:
                out.append((line, open_.main))

    def cut(i: int) -> None:
        if i >= 0:
            flush()
            open_.cut(i)

    while at < len(html):
        m = TAG.search(html, at)
        end = m.start() if m else len(html)
        if end > at and not open_.dropped:
            text.append(html[at:end])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            i = open_.last((name,))
            if i >= 0:
                cut(i) if name in BLOCK or open_.stack[i][1] else open_.close(i)
            continue
        if name == "br":
            text.append(" ") if not open_.dropped else None
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in MAIN:  # an article can't lie in a menu, and a form around one holds the page: what was left open before it ends
            cut(open_.outermost(("nav", "header", "footer", "aside", "head", "menu", "form")))
        if name in CLOSES_P or name in SIBLINGS:
            i = open_.last(ENDS.get(name, ("p",)))
            if i >= (open_.blocks[-1] if open_.blocks else 0):
                cut(i)
        dropped, main = open_.dropped, open_.main
        drop, own = (True, False) if dropped else _marked(name, m[3] or "", main > 0)
        if name in BLOCK or drop:
            flush()
        if name in RAW:
            close = re.compile(rf"</{name}\s*>?", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        if m[0].endswith("/>") and name in ("svg", "math", "path"):
            continue
        if own and not drop and not main:
            containers += 1
            main = containers
        open_.push(name, dropped or drop, 0 if drop else main)
    flush()
    return out


ROOM = 1 << 28  # bits of the rows that an alignment keeps at a time


class _Places:
    """Where each value stands in b[lo:hi], as the bits of a number. Numbers are kept while all of them fit, else made as they are asked for."""

    def __init__(self, b: list[int]):
        self.size, self.at = len(b), {}
        for j, v in enumerate(b):
            self.at.setdefault(v, []).append(j)
        self.keep = len(self.at) * self.size <= ROOM
        self.made: dict[int, int] = {}

    def bits(self, v: int) -> int:
        if v not in self.at:
            return 0
        if v in self.made:
            return self.made[v]
        there = np.zeros(self.size, np.uint8)
        there[self.at[v]] = 1
        x = int.from_bytes(np.packbits(there, bitorder="little").tobytes(), "little")
        if self.keep:
            self.made[v] = x
        return x


def _rows(a: list[int], b: list[int]):
    """Longest common subsequences of ever more of a with all beginnings of b, in one number each: bit j is 0 where b[:j + 1] has one more than b[:j]."""
    places, every = _Places(b), (1 << len(b)) - 1
    row = every
    for v in a:
        x = row & places.bits(v)
        row = ((row + x) | (row - x)) & every
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of a with each beginning of b."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):  # noqa: B007  the last one counts
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), count=len(b), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits, dtype=np.int64)])


def shared(a: list[int], b: list[int]) -> set[int]:
    """Places in a that a longest common subsequence with b takes.

    Rows are numbers of len(b) bits, so a step of the alignment is a few operations on them, whatever matches. They are kept to trace the
    subsequence back; where they would not fit in ``ROOM``, a is halved, and b where both halves together have most (linear space)."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    tail = 0
    while tail < hi - lo and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = set(range(lo)) | set(range(len(a) - tail, len(a)))
    todo = [(lo, len(a) - tail, lo, len(b) - tail)]
    while todo:
        i, i_end, j, j_end = todo.pop()
        if i >= i_end or j >= j_end:
            continue
        if i_end - i > 1 and (i_end - i) * (j_end - j) > ROOM:
            half = (i + i_end) // 2
            both = _lengths(a[i:half], b[j:j_end]) + _lengths(a[half:i_end][::-1], b[j:j_end][::-1])[::-1]
            cut = j + int(both.argmax())
            todo += [(i, half, j, cut), (half, i_end, cut, j_end)]
            continue
        rows = [(1 << (j_end - j)) - 1, *_rows(a[i:i_end], b[j:j_end])]
        r, c = len(rows) - 1, j_end - j
        while r and c:
            if rows[r] >> (c - 1) & 1:  # b's last line adds nothing
                c -= 1
            else:
                r -= 1
                if rows[r] >> (c - 1) & 1:  # it does since this line of a
                    found.add(i + r)
                    c -= 1
    return found


def _hashes(texts: list[str]) -> np.ndarray:
    points, bounds = C.codepoints(texts)
    return C.span_hashes(points, bounds[:-1], bounds[1:] - 1).view(np.int64)


def kept(own: list[str], containers: list[int], gone: set[int]) -> list[str]:
    """Lines of a page without those at the places ``gone``, save in the container that holds the page's text."""
    unshared, size = [0] * (max(containers, default=0) + 1), [0] * (max(containers, default=0) + 1)
    for i, (line, c) in enumerate(zip(own, containers, strict=True)):
        size[c] += len(line)
        unshared[c] += 0 if i in gone else len(line)
    best = max(range(1, len(size)), key=lambda c: (unshared[c], size[c]), default=0)
    if size[best] < unshared[0]:
        best = 0
    return [line for i, (line, c) in enumerate(zip(own, containers, strict=True)) if i not in gone or (best and c == best)]


def _parse(pages: list[str], part: pa.RecordBatch) -> dict:
    parsed = [lines(p) for p in pages]
    counts = np.array([len(p) for p in parsed])
    every = [t for p in parsed for t, _ in p]
    inside = np.array([c for p in parsed for _, c in p], np.int32)
    return {"lines": C.lists(every, counts, pa.string()), "containers": C.lists(inside, counts, pa.int32()), "hashes": C.lists(_hashes(every) if every else np.zeros(0, np.int64), counts, pa.int64())}


def pairs(rows: DataFrame) -> DataFrame:
    """page_id, url and the struct near (page_id, url) of the page of the same host whose path shares more leading segments; of two that share as many it is the one before."""
    keys = rows.select("page_id", "url").distinct().withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}).filter("host <> ''")
    follow = with_next(keys, ["host", "path", "page_id", "url"]).filter("next.host = host")
    segments = follow.select(F.struct("page_id", "url").alias("a"), F.struct("next.page_id", "next.url").alias("b"), F.split("path", "/").alias("p"), F.split("next.path", "/").alias("q"))
    same = F.aggregate(F.sequence(F.lit(1), F.least(F.size("p"), F.size("q"))), F.lit(0), lambda n, i: F.when((n == i - 1) & (F.element_at("p", i) == F.element_at("q", i)), i).otherwise(n))
    both = segments.select("a", "b", same.alias("common"))
    every = both.select(F.col("a").alias("page"), F.col("b").alias("near"), "common", F.lit(0).alias("before")).unionAll(both.select(F.col("b").alias("page"), F.col("a").alias("near"), "common", F.lit(1).alias("before")))
    return every.groupBy("page").agg(F.max_by("near", F.struct("common", "before")).alias("near")).select("page.page_id", "page.url", "near")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = pages.select("page_id", "url", "html")
    marks = C.settle(C.map_texts(pages, "page_id long, url string, hashes array<long>", _parse, "html"))
    near = pairs(marks)
    hashes = marks.dropDuplicates(["page_id", "url"]).select(F.struct("page_id", "url").alias("near"), F.col("hashes").alias("near_hashes"))
    known = near.join(hashes, "near").select(F.struct("page_id", "url").alias("page"), "near_hashes")
    # pages are parsed again, so that their lines are written once, by this join, and not in scratch space too
    parsed = C.map_texts(pages, "page_id long, url string, lines array<string>, containers array<int>, hashes array<long>", _parse, "html")
    both = parsed.withColumn("page", F.struct("page_id", "url")).join(known, "page", "left").select("page_id", "url", "lines", "containers", "hashes", "near_hashes")

    def difference(batches):
        for b in batches:
            texts = []
            for own, inside, h, other in zip(*(b.column(c).to_pylist() for c in ("lines", "containers", "hashes", "near_hashes")), strict=True):
                texts.append("\n".join(kept(own, inside, shared(h, other) if other else set())))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return both.mapInArrow(difference, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(C.table(spark, sf_dir, "pages"))
