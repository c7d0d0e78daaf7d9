"""HTML extraction: article text, by host-wide repeated substrings and markup.

Step 1 reads a page's markup once, in time linear in its length whatever it
holds: text inside menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments is left out (elements, roles and
the words of class and id attributes say so), the rest is cut into blocks at
block-level tags, marked if they stand inside ``article`` or ``main``.

Inside a marked container authors name headings and paragraphs after their
content: headings are never left out for a word, other elements that hold
text of their own (and the containers themselves) only for a class that is one
of the words as a whole, never for an id.

Step 2 takes the token streams of all pages of a host as one sequence and
finds the substrings of ``MIN_RUN`` tokens or more that belong to distinct
pages, as neighbours in the order of its suffixes:

1. Only suffixes that can have a twin are ordered: those in segments whose
   winnowed anchor (hashed with the host, see ``_anchors``) occurs again.
   Equal segments are one class; a class on two pages is repeated whole.
2. Where classes of one page share their anchor with others, the suffixes of
   one segment a class are sorted by their first ``MIN_RUN`` tokens in every
   task, neighbours that share them become one entry with its smallest and
   largest page, and the orders of the tasks are merged entry by entry.  So
   neither a host with a third of all pages nor a line on all of them meets in
   one task.
3. Overlapping repeats are joined to maximal runs.

Step 3 judges every page by its runs.  Text outside of marked containers is
boilerplate where a run covers it.  The containers are the article unless
what is left outside outweighs them ``MARKED_PART`` - 1 times.  As the exact
check by markup, containers that are the article give their blocks whole, so
an article that a host publishes twice stays; other pages give their unique runs.

Defined results
  * null or empty html: empty text;
  * null url: host ``''``; null page_id: a page of its own;
  * rows that share a page_id are one page to step 2 (they never make each
    other boilerplate), and one result row each;
  * unclosed, misnested or cut-off markup: read to the end, elements left
    open end with their container; a ``<`` that begins no tag is text;
  * empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._anchors import Unit, _mix, merged, pack, unpack
from dimforge.llm._common import Scratch, ascii_lower, read

#: Tokens a repeated substring must have, and tokens of an anchor.
MIN_RUN = 12
GRAM = 4

#: Segments and texts are shuffled in so many rounds, so that only a part of them is on disk at a time.
ROUNDS = 3
TEXT_ROUNDS = 3

#: A page whose text inside marked containers is less than one part in this many is not marked.
MARKED_PART = 6

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"']*")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names and attribute words.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP = frozenset(
    "head nav header footer aside form script style noscript template svg math iframe object canvas audio video "
    "button select textarea label fieldset dialog menu title".split())
MAIN = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Left out by name outside of marked containers only (in them a label or a formula is text, unless a form holds it).
DROP_OUTSIDE = frozenset("label math".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose own text an article consists of.
TEXT = frozenset("p li dt dd td th tr blockquote pre figcaption figure label math span a b i em strong code table".split())
DROP_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
DROP_WORD = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination header masthead footer sidebar aside widget "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup "
    "comment comments respond disqus share sharing social related recommended form login search".split())
#: A start tag closes an open element of these names inside the same container.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
#: An end tag does not close what lies outside of the nearest of these, but for those that end them.
WALL = frozenset("article main body td th".split())
BREAKS_WALL = frozenset("article main body html table tr".split())
P_ENDS = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option"}


class _Tags:
    """The tags of a page in order.  Every part of the page is looked at a
    bounded number of times: what a search did not find is remembered."""

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.last = page.rfind(">")
        self.piece = (0, -1)  # a stretch without quotes and ``>``, and its end
        self.dead: set[int] = set()  # from these quotes on, no tag ends outside of quotes

    def _plain_end(self, at: int) -> int:
        lo, hi = self.piece
        if not lo <= at <= hi:
            self.piece = (at, _PLAIN.match(self.page, at).end())
        return self.piece[1]

    def _end(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``: the first ``>``
        outside of quotes, or the first at all if quotes do not pair up."""
        page, pos, seen = self.page, at, []
        while (q := self._plain_end(pos)) < self.size and q not in self.dead:
            if page[q] == ">":
                return q
            seen.append(q)
            closing = page.find(page[q], q + 1)
            if closing < 0:
                break
            pos = closing + 1
        self.dead.update(seen)
        return page.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, end, name, closing, attributes) of the next tag; comments and declarations have no name."""
        page = self.page
        while (lt := page.find("<", at)) >= 0:
            if lt > self.last or page.startswith("<!--", lt):
                lt = page.find("<!--", lt)  # only an unclosed comment can follow the last ``>``
                if lt < 0:
                    return None
                for short in (">", "->"):
                    if page.startswith(short, lt + 4):
                        return lt, lt + 4 + len(short), "", False, ""
                end = page.find("-->", lt + 4)
                return lt, end + 3 if end >= 0 else self.size, "", False, ""
            m = _NAME.match(page, lt)
            if m:
                end = self._end(m.end())
                return lt, end + 1, m[2].lower(), bool(m[1]), page[m.end():end]
            if page[lt + 1:lt + 2] in ("!", "?", "/"):
                return lt, page.find(">", lt) + 1, "", False, ""
            at = lt + 1
        return None


_ZEROS = re.compile(r"&#0+(?=[0-9])")
_LONG_REFERENCE = re.compile(r"&#[0-9]{8,};?")


def _unescape(text: str) -> str:
    """Character references decoded (numbers beyond Unicode, of any length, as the replacement character)."""
    if "&#" in text:
        text = _LONG_REFERENCE.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): _unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


def _dropped(name: str, attrs: str, main: bool) -> bool:
    if name in DROP and not (main and name in DROP_OUTSIDE):
        return True
    if name in ("body", "html") or not attrs.strip():
        return False
    a = _attributes(attrs)
    if "hidden" in a or re.search(r"display\s*:\s*none", a.get("style", "")) or a.get("role", "").lower() in DROP_ROLE:
        return True
    if main and name in HEADING:
        return False
    if name in MAIN or a.get("role", "").lower() == "main" or main and name in TEXT:
        return not DROP_WORD.isdisjoint(a.get("class", "").lower().split())
    words = re.split(r"[^a-z]+", (a.get("class", "") + " " + a.get("id", "")).lower())
    return not DROP_WORD.isdisjoint(words)


class _Open:
    """The open elements, with what is needed to find one in constant time."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool]] = []  # name, left out, in main
        self.where: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.walls: list[int] = []

    def push(self, name: str, drop: bool, main: bool, block: bool) -> None:
        at = len(self.stack)
        self.stack.append((name, drop, main))
        self.where.setdefault(name, []).append(at)
        if block:
            self.blocks.append(at)
        if name in WALL:
            self.walls.append(at)

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            at = len(self.stack) - 1
            self.where[self.stack.pop()[0]].pop()
            for marks in (self.blocks, self.walls):
                if marks and marks[-1] == at:
                    marks.pop()

    def end_tag(self, name: str) -> None:
        """Closes the nearest open element of that name, unless its container began after it."""
        found = self.where.get(name)
        if found and (name in BREAKS_WALL or not self.walls or found[-1] >= self.walls[-1]):
            self.pop_to(found[-1])

    def start_tag(self, name: str) -> None:
        """Closes what ends where this element begins."""
        ends = CLOSES.get(name, {"p"} if name in P_ENDS else ())
        while ends and self.blocks and self.stack[self.blocks[-1]][0] in ends:
            self.pop_to(self.blocks[-1])
            ends = ends - {"p"}

    def state(self) -> tuple[bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False)


def ordered_blocks(page: str | None) -> list[tuple[bool, str]]:
    """(inside article or main, text) of the blocks that are not left out, in page order."""
    page = page or ""
    out: list[tuple[bool, str]] = []
    part: list[str] = []
    opened, tags = _Open(), _Tags(page)
    drop = main = False
    at = 0

    def end_block() -> None:
        if part:
            text = " ".join(_unescape("".join(part)).split())
            part.clear()
            if text:
                out.append((main, text))

    while tag := tags.next(at):
        start, end, name, closing, attrs = tag
        if start > at and not drop:
            part.append(page[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            if not drop:
                part.append(" ")
            continue
        block = name in BLOCK or name in DROP and not (main and name in DROP_OUTSIDE)
        if block:
            end_block()
        if closing:
            opened.end_tag(name)
            drop, main = opened.state()
            continue
        if name in RAW:
            e = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = page.find(">", e.end()) + 1 if e else 0
            at = at or len(page)  # raw text to the end
            continue
        opened.start_tag(name)
        drop, main = opened.state()
        if name in VOID or attrs.endswith("/") and name not in BLOCK:
            continue
        drop, main = drop or _dropped(name, attrs, main), main or name in MAIN or 'role="main"' in attrs
        opened.push(name, drop, main, block)
    if not drop:
        part.append(page[at:])
    end_block()
    return out


def blocks(page: str | None) -> tuple[list[str], list[str]]:
    """(blocks inside article or main, other blocks) that are not left out."""
    found = ordered_blocks(page)
    return [t for m, t in found if m], [t for m, t in found if not m]


def is_marked(found: list[tuple[bool, str]], unique: list[str] | None = None) -> bool:
    """Whether the text inside marked containers is (most of) what the page has.

    ``unique``: of every block, what no other page of the host repeats."""
    unique = [t for _, t in found] if unique is None else unique
    inside = sum(len(t) for m, t in found if m)
    outside = sum(len(u) for (m, _), u in zip(found, unique) if not m)
    return not found or inside * MARKED_PART >= inside + outside


def _host(url):
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def parse(pages: DataFrame) -> DataFrame:
    """page_id, url, host and the blocks of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [ordered_blocks(t.as_py()) for t in b.column(3)]
            ends = np.cumsum([0, *map(len, found)])
            of_all = pa.StructArray.from_arrays([pa.array([m for f in found for m, _ in f], pa.bool_()),
                                                 pa.array([t for f in found for _, t in f], pa.string())], ["main", "text"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1), b.column(2), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), of_all)],
                ["page_id", "url", "host", "blocks"])

    return pages.select("page_id", "url", _host(F.col("url")).alias("host"), "html").mapInArrow(
        run, "page_id long, url string, host string, blocks array<struct<main:boolean,text:string>>")


def _per_page(col: pa.Array, field: int) -> Iterator[list]:
    """One field of the blocks of every page."""
    values, at = col.flatten().field(field).to_pylist(), 0
    for n in col.value_lengths().to_pylist():
        yield values[at:at + n]
        at += n


def _streams(col: pa.Array) -> list[str]:
    """The token stream of every page: its blocks, tokens joined by spaces."""
    return [" ".join(texts) for texts in _per_page(col, 1)]


def _segments(unit: Unit, hosts: pa.Array, col: pa.Array, digests: bool = False) -> tuple[np.ndarray, ...]:
    """``segments_of`` the token streams, anchors hashed with the host."""
    text, h, *rest = unit.segments_of(pa.array([t.encode() for t in _streams(col)], pa.binary()), digests)
    host = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in hosts.to_pylist()), np.uint64, len(hosts))
    return text, _mix(h ^ host[text]).view(np.int64), *rest


def _anchors(unit: Unit):
    """(h, n): how often an anchor of a host occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, n = np.unique(_segments(unit, b.column(0), b.column(1))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])

    return run


def _occurrences(unit: Unit, turn: int):
    """(anchor, digest, page, row, place) of the segments of one round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _segments(unit, b.column(0), b.column(1), digests=True)
            mine = found[1] % ROUNDS == turn
            text, h, start, count, offset, digest = (c[mine] for c in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(digest.view(np.int64)), pa.array(b.column(2).to_numpy()[text]),
                 pa.array(b.column(3).to_numpy()[text]), pa.array(pack(start, offset, count))], ["h", "s", "page", "row", "x"])

    return run


def _suffixes(size: int):
    """Every suffix of the given segments: host, first tokens, class, place in the segment, the class's pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, stream, found in zip(b.column(0).to_pylist(), _streams(b.column(1)), b.column(2).to_pylist()):
                t = stream.split(" ")
                for f in found:
                    start, _, n = unpack(f["x"])
                    rows += [(host, " ".join(t[start + i:start + i + size]), f["h"], f["s"], i, f["lo"], f["hi"]) for i in range(n)]
            cols = list(zip(*rows)) or [()] * 7
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], ["host", "prefix", "h", "s", "i", "lo", "hi"])

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, prefix, lo, hi: one entry for neighbours in the order that share their first tokens (and one a batch)."""
    for b in batches:
        if not b.num_rows:
            continue
        host, prefix = b.column(0).to_pylist(), b.column(1).to_pylist()
        first = [i for i in range(len(host)) if not i or prefix[i] != prefix[i - 1] or host[i] != host[i - 1]]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(first)), b.column(1).take(pa.array(first)),
             pa.array(np.minimum.reduceat(b.column(2).to_numpy(), first)), pa.array(np.maximum.reduceat(b.column(3).to_numpy(), first))],
            ["host", "prefix", "lo", "hi"])


def find_repeats(parsed: DataFrame, scratch: Scratch, size: int = MIN_RUN) -> DataFrame:
    """row, ranges: the token ranges [lo, hi) of a page that another page of its host repeats (they may overlap).

    ``parsed`` is a written table with a column ``row`` that numbers its rows."""
    unit = Unit(size, GRAM, words=True)
    s = scratch
    counts = parsed.select("host", "blocks").mapInArrow(_anchors(unit), "h long, n long")
    again = s.write(counts.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h"), "again")
    own = F.coalesce("page_id", -F.col("row") - 1)
    streams = parsed.select("host", "blocks", own.alias("page"), "row")
    found = []
    for k in range(ROUNDS):
        s.release()
        each = streams.mapInArrow(_occurrences(unit, k), "h long, s long, page long, row long, x long")
        found.append(s.write(each.join(again.hint("shuffle_hash"), "h"), f"occurrences-{k}"))
    occ = reduce(DataFrame.unionByName, found)
    s.drop("again")
    classes = s.write(occ.groupBy("h", "s").agg(F.min("page").alias("lo"), F.max("page").alias("hi"),
                                                F.min(F.struct("row", "x")).alias("first")).select("h", "s", "lo", "hi", "first.*"), "classes")
    start, windows = F.shiftright("x", 16), F.col("x").bitwiseAND(255)
    s.release()
    whole = (occ.join(classes.filter("lo <> hi").select("h", "s"), ["h", "s"])
             .select("row", start.alias("lo"), (start + windows + (size - 1)).alias("hi")))
    whole = s.write(whole, "whole")

    # classes of one page that share their anchor with another page
    mixed = (classes.groupBy("h").agg(F.min("lo").alias("a"), F.max("hi").alias("z"), F.max(F.expr("lo = hi")).alias("open"))
             .filter("a <> z and open").select("h"))
    need = classes.join(s.write(mixed, "mixed"), "h").groupBy("row").agg(F.collect_list(F.struct("h", "s", "x", "lo", "hi")).alias("found"))
    need = s.write(need, "open")
    s.drop("classes", "mixed")
    found = []
    for k in range(TEXT_ROUNDS):
        s.release()
        mine = F.col("row") % TEXT_ROUNDS == k
        texts = parsed.select("row", "host", "blocks").filter(mine).join(need.filter(mine), "row").select("host", "blocks", "found")
        found.append(s.write(texts.mapInArrow(
            _suffixes(size), "host string, prefix string, h long, s long, i int, lo long, hi long"), f"suffixes-{k}"))
    suffixes = reduce(DataFrame.unionByName, found)
    s.drop("open")
    order = suffixes.select("host", "prefix", "lo", "hi").sortWithinPartitions("host", "prefix").mapInArrow(
        _neighbours, "host string, prefix string, lo long, hi long")
    repeated = s.write(order.groupBy("host", "prefix").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
                       .filter("lo <> hi").select("host", "prefix"), "repeated")
    # each of the last shuffles is a step of its own: what the one before read is deleted first
    open_at = []
    for k, part in enumerate(found):
        part = part.filter("lo = hi").join(repeated, ["host", "prefix"], "left_semi").select("h", "s", "i")
        open_at.append(s.write(part, f"single-{k}"))
        s.drop(f"suffixes-{k}")
    single = reduce(DataFrame.unionByName, open_at)
    s.drop("repeated")
    at = start + F.col("i")
    partly = s.write(occ.join(single, ["h", "s"]).select("row", at.alias("lo"), (at + size).alias("hi")), "partly")
    s.drop(*[f"single-{k}" for k in range(TEXT_ROUNDS)], *[f"occurrences-{k}" for k in range(ROUNDS)])
    out = s.write(whole.unionByName(partly).groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")
    s.drop("whole", "partly")
    return out


def article(found: list[tuple[bool, str]], runs: list[tuple[int, int]]) -> str:
    """The text of a page from its blocks and the runs of tokens that its host repeats."""
    texts = [t for _, t in found]
    if runs and not all(m for m, _ in found):
        covered = {i for lo, hi in runs for i in range(lo, hi)}
        at = 0
        for k, t in enumerate(texts):
            words = t.split(" ")
            texts[k] = " ".join(w for i, w in enumerate(words, at) if i not in covered)
            at += len(words)
    if is_marked(found, texts):
        return "\n".join(t for m, t in found if m)
    return "\n".join(t for t in texts if t)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        blocks = b.column(2)
        text = [article(list(zip(*page)), runs) for *page, runs in zip(_per_page(blocks, 0), _per_page(blocks, 1), merged(b.column(3)))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page; each page is parsed once."""
    scratch = Scratch(pages.sparkSession, "html")
    parsed = scratch.write(parse(pages).withColumn("row", F.monotonically_increasing_id()), "parsed")
    repeats = find_repeats(parsed, scratch)
    # runs say nothing about a page without text outside of its containers: its blocks need not meet them
    free = F.exists("blocks", lambda b: ~b["main"])
    pages = (parsed.filter(free).join(repeats, "row", "left").select("page_id", "url", "blocks", "ranges")
             .unionByName(parsed.filter(~free).select("page_id", "url", "blocks", F.lit(None).cast(repeats.schema["ranges"].dataType).alias("ranges"))))
    judged = pages.mapInArrow(_judge, "page_id long, url string, text string")
    return judged.withColumn("n_chars", F.length("text").cast("long"))


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


# the pages of the data mark their article; its blocks are headings and paragraphs
ORACLE_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages
), b AS (
  SELECT page_id, url, list_transform(regexp_split_to_array(body, '</?(?:h1|p)>'),
    lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) AS parts
  FROM a
), c AS (
  SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM b
)
SELECT page_id, url, text, length(text) AS n_chars FROM c
"""
