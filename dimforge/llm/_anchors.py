"""Winnowed anchors: which parts of documents can repeat, found by shuffles
of anchor hashes only.

A document is a sequence of symbols (bytes or words).  Every window of
``length`` symbols selects one anchor: its gram of ``gram`` symbols with the
smallest hash (the leftmost of equals).  The choice depends on the window's
content only, so equal windows anywhere select equal anchors at equal
offsets.  Neighbouring windows mostly share their anchor; the windows of one
anchor and the symbols under them are a *segment*.

``Repeats`` finds, for all documents at once,
  * segments whose anchor occurs again (the others cannot hold a repeat),
  * classes of equal segments: in every segment but the first of its class,
    each window starts earlier, so it is covered whole,
  * the first segments of classes that share their anchor with another
    class: only there single windows must be compared, which is left to the
    operator (``resolve``).
Copies, however many, are one class and cost one row per anchor.

Documents are told apart by (doc_id, content hash): rows that share a doc_id
but not their text are versions of one document, judged apart; at equal
starts neither is the earlier one.  A null doc_id sorts before all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import Scratch, bounded_batches

_U = np.uint64
_MUL = 0x9E3779B97F4A7C15
_RANDOM = np.random.default_rng(20240607).integers(0, 2**64, (2, 256), dtype=np.uint64)
_INDEX = 20  # low bits of a gram's key hold its place in the block
_BLOCK = 1 << 15
_TERMS = _BLOCK + 4096  # symbols of a block: its windows and the rest of the last one
_PLACES = np.arange(_TERMS)
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
_LONG_WORD = 64  # bytes of a word that sums of its bytes tell apart well; xxh3 takes longer ones
NULL_ID = -(2**63)


def _powers(mul: int, n: int) -> np.ndarray:
    out = np.full(n, mul, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Prefix:
    """Hashes of any run of symbols from sums over the symbols before it:
    sum of symbol * mul ** place, divided by mul ** (place of the run)."""

    def __init__(self, mul: int):
        self.up, self.down = _powers(mul, _TERMS), _powers(pow(mul, -1, 2**64), _TERMS)

    def sums(self, sym: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sym) + 1, np.uint64)
        np.cumsum(sym * self.up[:len(sym)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (sums[hi] - sums[lo]) * self.down[lo]

    def grams(self, sums: np.ndarray, k: int) -> np.ndarray:
        n = len(sums) - k
        return (sums[k:] - sums[:n]) * self.down[:n]


@dataclass(frozen=True)
class Unit:
    """What repeats are made of: windows of ``length`` symbols, selected by
    grams of ``gram`` symbols; symbols are bytes or words."""

    length: int
    gram: int
    words: bool

    def cut(self, text: bytes) -> tuple[int, Callable[[int, int], bytes]]:
        """The number of symbols, and the content of symbols [a, b)."""
        if not self.words:
            return len(text), lambda a, b: text[a:b]
        words = text.split()
        n = len(words)
        joined = b" ".join(words)
        e = (np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1).tolist() if n else []
        return n, lambda a, b: joined[e[a - 1] + 1 if a else 0:e[b - 1]]

    def _symbols(self, texts: list[bytes]) -> tuple[Callable[[int, int, int], np.ndarray], np.ndarray]:
        """(two hash functions of symbols [a, b) of all texts in a row, symbols per text)."""
        if not self.words:
            flat = np.frombuffer(b"".join(texts), np.uint8)
            return lambda which, a, b: _RANDOM[which][flat[a:b]], np.fromiter(map(len, texts), np.int64, len(texts))
        joined = b" ".join(texts)
        gap = np.concatenate(([True], _SPACE[np.frombuffer(joined, np.uint8)], [True]))
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        lo, hi = edges[::2], edges[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        size = np.diff(np.searchsorted(lo, begins))
        sym = _word_hashes(joined, lo, hi)
        return lambda which, a, b: _mix(sym[a:b]) if which else sym[a:b], size

    def segments(self, texts: list[bytes], digests: bool = False) -> tuple[np.ndarray, ...]:
        """(text, anchor hash, first window, windows, anchor's offset, digest
        of the symbols) of every segment of every text.

        The texts are taken in a row, so that short ones cost no calls of
        their own; windows that would cross their bounds are left out."""
        w = self.length - self.gram + 1
        symbols, size = self._symbols(texts)
        ends = np.cumsum(size)
        n = int(ends[-1]) if len(ends) else 0
        bounds = [(e - k, e) for e, k in zip(ends.tolist(), size.tolist()) if k >= self.length]
        out = []
        for lo in range(0, n - self.length + 1, _BLOCK):
            hi = min(lo + _BLOCK, n - self.length + 1)
            # windows inside one text; an anchor belongs to one text, so runs of equal anchors do too
            inside = [_PLACES[max(b, lo) - lo:min(e - self.length + 1, hi) - lo] for b, e in bounds if e - self.length >= lo and b < hi]
            inside = np.concatenate([*inside, _PLACES[:0]])
            if not len(inside):
                continue
            sums = _P0.sums(symbols(0, lo, hi + self.length - 1))
            h = _P0.grams(sums, self.gram)
            key = h & _U(2**64 - (1 << _INDEX))
            key |= _PLACES[:len(h)].view(np.uint64)
            at = (_sliding_min(key, w)[inside] & _U((1 << _INDEX) - 1)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            count, start = np.diff(np.append(first, len(at))), inside[first]
            text = np.searchsorted(ends, start + lo, side="right")
            digest = np.zeros(len(first), np.uint64)
            if digests:
                stop = start + count + (self.length - 1)
                again = _P1.sums(symbols(1, lo, hi + self.length - 1))
                digest = _mix(_P0.runs(sums, start, stop) + _mix(_P1.runs(again, start, stop)))
            out.append((text, h[at[first]], start + lo - (ends[text] - size[text]), count, at[first] - start, digest))
        if not out:
            z = np.zeros(0, np.int64)
            return z, np.zeros(0, np.uint64), z, z, z, np.zeros(0, np.uint64)
        return tuple(np.concatenate(c) for c in zip(*out))

    def segments_of(self, col: pa.Array, digests: bool = False) -> tuple[np.ndarray, ...]:
        """``segments`` of a batch's texts, as many at a time as fit in a
        block: only a text of several blocks is cut between them, always at the same
        places."""
        out, texts, first, held = [], [], 0, 0
        for i, t in enumerate(col):
            t = t.as_py()
            if texts and held + len(t) > _BLOCK:
                out.append((first, self.segments(texts, digests)))
                texts, first, held = [], i, 0
            texts.append(t)
            held += len(t)
        out.append((first, self.segments(texts, digests)))
        return tuple(np.concatenate(c) for c in zip(*((found[0] + k, *found[1:]) for k, found in out)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(_MUL)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (w - size)], x[w - size:]) if w > size else x


_P0, _P1 = _Prefix(_MUL), _Prefix(0xD6E8FEB86659FD93)


def _word_hashes(text: bytes, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of every word text[lo:hi], of its bytes only."""
    flat, out = np.frombuffer(text, np.uint8), np.zeros(len(lo), np.uint64)
    long = hi - lo > _LONG_WORD
    i = 0
    while i < len(lo):
        a = lo[i]
        k = max(i + 1, int(np.searchsorted(hi, a + _TERMS, side="right")))
        if not long[i:k].all():
            sums = _P0.sums(_RANDOM[0][flat[a:hi[k - 1]]])
            out[i:k] = _mix(_P0.runs(sums, lo[i:k] - a, hi[i:k] - a))
        i = k
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh3_64_intdigest(text[lo[i]:hi[i]])
    return out


def pack(start: np.ndarray, offset: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """One long: start of the segment, anchor's offset, number of windows (at most 255)."""
    return (start << 16) | (offset << 8) | windows


def unpack(x):
    return x >> 16, (x >> 8) & 255, x & 255


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """did, ver, text (binary, null: empty) and the whole input row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("did"),
        F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("ver"), text.alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


class Repeats:
    def __init__(self, docs: DataFrame, unit: Unit, name: str, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = docs.sparkSession
        bounded_batches(self.spark)
        self.unit = unit
        self.docs = identified(docs, id_col, text_col)
        self.scratch = Scratch(self.spark, name)

    # -- rows made from texts ------------------------------------------------
    def _anchor_counts(self) -> DataFrame:
        unit = self.unit

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                h, n = np.unique(unit.segments_of(b.column(0))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        return self.docs.select("text").mapInArrow(run, "h long, n long")

    def _occurrences(self) -> DataFrame:
        unit = self.unit

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                text, h, start, count, offset, digest = unit.segments_of(b.column(2), digests=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(h.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(b.column(0).to_numpy()[text]),
                    pa.array(b.column(1).to_numpy()[text]), pa.array(pack(start, offset, count))], ["h", "s", "did", "ver", "x"])

        return self.docs.select("did", "ver", "text").mapInArrow(run, "h long, s long, did long, ver int, x long")

    # -- classes -----------------------------------------------------------
    def prepare(self) -> None:
        s = self.scratch
        again = s.write(self._anchor_counts().groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h"), "again")
        self.occ = s.write(self._occurrences().join(again, "h"), "occurrences")
        s.drop("again")
        first = F.min(F.struct("did", "x", "ver")).alias("first")
        self.classes = s.write(self.occ.groupBy("h", "s").agg(first).select("h", "s", "first.*"), "classes")
        several = s.write(self.classes.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "several")
        self.open = s.write(self.classes.join(several, "h"), "open")
        # versions of one document may hold a class's first segment at the same place: each is one of its first
        versions = s.write(self.occ.groupBy("did").agg(F.min("ver").alias("lo"), F.max("ver").alias("hi"))
                           .filter("lo <> hi").select("did"), "versions")
        if versions.take(1):
            opened = self.open.select("h", "s", F.col("did").alias("d"), F.col("x").alias("at"), F.col("ver").alias("own"))
            more = (self.occ.join(versions, "did", "left_semi").join(opened, ["h", "s"])
                    .filter("did = d and x = at and ver <> own").select("h", "s", "did", "x", "ver").distinct())
            self.open = self.open.unionByName(s.write(more, "open-versions"))

    def covered_whole(self) -> DataFrame:
        """did, ver, lo, hi of every segment that is not the first of its class."""
        first = self.classes.select("h", "s", F.struct("did", "x").alias("first"))
        later = self.occ.join(first, ["h", "s"]).filter(F.struct("did", "x") > F.col("first"))
        start, _, windows = F.shiftright("x", 16), None, F.col("x").bitwiseAND(255)
        return later.select("did", "ver", start.alias("lo"), (start + windows + (self.unit.length - 1)).alias("hi"))

    def open_texts(self, run: Callable, schema: str) -> DataFrame:
        """``run`` over (did, ver, text, [x of the open segments]) of the documents that have some."""
        need = self.open.groupBy("did", "ver").agg(F.collect_list("x").alias("open"))
        rows = self.docs.select("did", "ver", "text").join(need, ["did", "ver"])
        return rows.select("did", "ver", "text", "open").mapInArrow(run, schema)

    # -- result --------------------------------------------------------------
    def spans(self, ranges: DataFrame) -> DataFrame:
        """row, text (binary) and the covered ranges [lo, hi) of every document."""
        per_doc = self.scratch.write(
            ranges.groupBy("did", "ver").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")
        return self.docs.join(per_doc, ["did", "ver"], "left").select("row", "text", "ranges")


def merged(ranges: pa.ListArray) -> Iterator[list[tuple[int, int]]]:
    """For every row's ranges, the maximal runs of their union."""
    flat = ranges.flatten()
    lo_all, hi_all = flat.field(0).to_numpy(), flat.field(1).to_numpy()
    at = 0
    for n in ranges.value_lengths().fill_null(0).to_pylist():
        if not n:
            yield []
            continue
        lo, hi = lo_all[at:at + n], hi_all[at:at + n]
        at += n
        order = np.argsort(lo, kind="stable")
        lo, hi = lo[order], np.maximum.accumulate(hi[order])
        cut = np.flatnonzero(lo[1:] > hi[:-1])
        yield list(zip(lo[np.concatenate(([0], cut + 1))].tolist(), hi[np.concatenate((cut, [n - 1]))].tolist()))
