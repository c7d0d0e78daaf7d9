"""Suffix-array dedup: suffixes ordered to a bounded depth by a distributed
difference-cover algorithm.

A window (the first ``length`` bytes of a suffix) is removed when it also
starts earlier.  Only suffixes that can have a twin are ordered: those in
segments whose winnowed anchor occurs again, one segment of each class of
equal ones (``_anchors``); the rest of a class starts later by definition.

The order is built as in difference-cover suffix sorting:

1. Sample.  Positions at multiples of ``step`` from a segment's anchor.
   Windows with equal bytes have their anchor at the same offset, so any two
   that are compared meet the sample at the same distance: the differences
   to be covered are all 0, and one residue covers them.  (The residues
   {1, 2} modulo 3, which cover every difference, would put two thirds of
   all positions into the sample.)
2. Name.  The ``step`` bytes at every sampled position are sorted and named
   by rank.
3. Recurse.  Triples of consecutive names are sorted and named by rank.  Two
   triples span the sampled part of a window, so the recursion ends there.
   Names that occur once are discarded at either level: a window over one
   has no twin.
4. Merge.  Every remaining suffix gets the key (rank of its first triple,
   rank of its last triple, bytes before and after the sampled part); equal
   keys are equal windows.
5. Compare.  Suffixes are sorted by key, then position; one whose key equals
   its neighbour's starts later than it and is repeated.

Names are ranks by Spark's range partitioning and row numbers within it, so
they need no count of what lies before.  Sorted keys are distinct (they are
aggregated first) except in step 5, where the suffixes of one key stream
through a task one after the other; a class of copies has one of them.

Defined results
  * null or empty text, shorter than ``length``: nothing removed;
  * null doc_id: sorts before all others; rows sharing a doc_id: see ``_anchors``;
  * identical rows (same id and text) are one document and get the same result;
  * empty table: empty result; extra columns pass through ``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._anchors import Repeats, Unit, merged, unpack
from dimforge.llm._common import PIECE, read

LENGTH = 100
GRAM = 24
BYTES = Unit(LENGTH, GRAM, words=False)
MIN_LENGTH = 12


def step_of(length: int) -> int:
    """Sample distance: a window then holds five or six whole steps."""
    if length < MIN_LENGTH:
        raise ValueError(f"length must be at least {MIN_LENGTH}")
    return length // 6


def _segment_texts(unit: Unit):
    """The bytes of every open segment, a bounded number of segments at a time."""
    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        did, ver, x, text = cols = [], [], [], []
        for b in batches:
            for d, v, t, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                t = t.as_py()
                for at in range(0, len(found), PIECE):
                    for o in found.values.slice(at, PIECE).to_pylist():
                        start, _, n = unpack(o)
                        did.append(d)
                        ver.append(v)
                        x.append(o)
                        text.append(t[start:start + n - 1 + unit.length])
                    if len(x) >= PIECE:
                        yield _batch(cols, types, ["did", "ver", "x", "text"])
            yield _batch(cols, types, ["did", "ver", "x", "text"])

    return run


def _batch(cols: tuple[list, ...], types: tuple[pa.DataType, ...], names: list[str]) -> pa.RecordBatch:
    """A batch of the columns, which are emptied."""
    out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names)
    for c in cols:
        c.clear()
    return out


def _blocks(step: int):
    """(sid, j, key): the bytes at every sampled position; j counts steps from the first one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, at, key = [], [], []
            for s, x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                first = unpack(x)[1] % step
                some = [t[q:q + step] for q in range(first, len(t) - step + 1, step)]
                sid += [s] * len(some)
                at += range(len(some))
                key += some
            yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(at, pa.int32()), pa.array(key, pa.binary())], ["sid", "j", "key"])

    return run


def named(rows: DataFrame, key: list[str], scratch, tag: str, parts: int) -> DataFrame:
    """sid, j, name: the rank of each key that occurs at least twice; other rows are discarded."""
    twice = scratch.write(rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key), f"{tag}-twice")
    ranks = twice.repartitionByRange(parts, *key).sortWithinPartitions(*key).withColumn("name", F.monotonically_increasing_id())
    ranks = scratch.write(ranks, f"{tag}-ranks")
    out = scratch.write(rows.join(ranks, key).select("sid", "j", "name"), f"{tag}-names")
    scratch.drop(f"{tag}-twice", f"{tag}-ranks")
    return out


def _triples(names: DataFrame) -> DataFrame:
    """sid, j, a, b, c: three consecutive names (a segment has a bounded number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = _names(found)
                out += [(s, j, a, at[j + 1], at[j + 2]) for j, a in at.items() if j + 1 in at and j + 2 in at]
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(cols)],
                                             ["sid", "j", "a", "b", "c"])

    return _per_segment(names).mapInArrow(run, "sid long, j int, a long, b long, c long")


def _per_segment(names: DataFrame) -> DataFrame:
    """sid and its names, each packed with its place (a segment holds fewer than 256 steps)."""
    return names.groupBy("sid").agg(F.collect_list(F.col("name") * 256 + F.col("j")).alias("found"))


def _names(found: list[int]) -> dict[int, int]:
    return {f & 255: f >> 8 for f in found}


def _suffixes(unit: Unit, step: int):
    """(first, last, rest, did, p, ver) of every suffix that kept both its
    triples, a bounded number at a time: a segment has many times its bytes in suffixes."""
    whole = (unit.length - step + 1) // step  # whole steps in any window
    one = [bytes((i,)) for i in range(step)]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
    names = ["first", "last", "rest", "did", "p", "ver"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, rest, dids, at, vers = cols = [], [], [], [], [], []
        for b in batches:
            for did, ver, x, t, found in zip(*(b.column(i).to_pylist() for i in range(5))):
                start, offset, n = unpack(x)
                zero = offset % step
                name = _names(found)
                for j, lo in name.items():
                    hi = name.get(j + whole - 3)
                    if hi is None:
                        continue
                    # the suffixes whose first sampled position is the j-th
                    q = zero + j * step
                    a, z = (q - step + 1 if j else 0), min(q + 1, n)
                    if a >= z:
                        continue
                    tail = q + whole * step
                    first += [lo] * (z - a)
                    last += [hi] * (z - a)
                    rest += [one[q - i] + t[i:q] + t[tail:i + unit.length] for i in range(a, z)]
                    dids += [did] * (z - a)
                    at += range(start + a, start + z)
                    vers += [ver] * (z - a)
                if len(at) >= PIECE:
                    yield _batch(cols, types, names)
            yield _batch(cols, types, names)

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """did, ver, p of the sorted suffixes whose key has an earlier one.

    Versions of one document at the same start are not earlier than each other."""
    before = None  # the last row of the batches so far: its key, and the first suffix with that key
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        first, last, did, p = (b.column(i).to_numpy() for i in (0, 1, 3, 4))
        rest = b.column(2)
        new = np.ones(n, bool)
        same = pc.equal(rest.slice(1), rest.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[1:] = ~(same & (first[1:] == first[:-1]) & (last[1:] == last[:-1]))
        goes_on = before is not None and before[0] == (first[0], last[0], rest[0].as_py())
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        head_did, head_p = did[head], p[head]
        if goes_on:
            here = head == 0
            head_did, head_p = np.where(here, before[1][0], head_did), np.where(here, before[1][1], head_p)
        before = ((first[-1], last[-1], rest[n - 1].as_py()), (head_did[-1], head_p[-1]))
        c = b.filter(pa.array((did != head_did) | (p != head_p)))
        yield pa.RecordBatch.from_arrays([c.column(3), c.column(5), c.column(4)], ["did", "ver", "p"])


def find_repeats(docs: DataFrame, unit: Unit = BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, text, ranges: covered byte ranges [lo, hi) of every document (may overlap)."""
    step = step_of(unit.length)
    whole = (unit.length - step + 1) // step
    if not 3 <= whole <= 6:
        raise ValueError(f"two triples must span {whole} steps")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = Repeats(docs, unit, "suffix-dedup", id_col, text_col)
    r.prepare()
    s = r.scratch
    seg = r.open_texts(_segment_texts(unit), "did long, ver int, x long, text binary")
    seg = s.write(seg.withColumn("sid", F.monotonically_increasing_id()), "segments")
    blocks = seg.select("sid", "x", "text").mapInArrow(_blocks(step), "sid long, j int, key binary")
    names = named(blocks, ["key"], s, "blocks", parts)
    triples = s.write(_triples(names), "triples")
    names3 = named(triples, ["a", "b", "c"], s, "triples-of", parts)
    suffixes = seg.join(_per_segment(names3), "sid").select("did", "ver", "x", "text", "found").mapInArrow(
        _suffixes(unit, step), "first long, last long, rest binary, did long, p long, ver int")
    order = suffixes.repartition(parts, "first", "last", "rest").sortWithinPartitions("first", "last", "rest", "did", "p")
    later = s.write(order.mapInArrow(_compare, "did long, ver int, p long"), "later")
    s.drop("blocks-names", "triples", "triples-of-names")
    partly = later.select("did", "ver", F.col("p").alias("lo"), (F.col("p") + unit.length).alias("hi"))
    return r.spans(r.covered_whole().unionByName(partly))


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for lo, hi in spans:
        out.append(text[at:lo])
        at = hi
    out.append(text[at:])
    return b"".join(out)


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without the parts of characters at their ends."""
    out = []
    for lo, hi in spans:
        while lo < hi and text[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(text) and text[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def remove_repeats(docs: DataFrame, unit: Unit = BYTES, id_col: str = "doc_id", text_col: str = "text",
                   characters: bool = False) -> DataFrame:
    """row (the input columns), ``kept`` (remaining bytes), ``n_bytes``,
    ``n_removed``, ``spans`` (maximal removed runs).  ``characters``: a
    character is removed only if all its bytes are covered, so that ``kept``
    is UTF-8 text."""
    marked = find_repeats(docs, unit, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, total, lost, runs = [], [], [], []
            for t, spans in zip(b.column(1).to_pylist(), merged(b.column(2))):
                if characters:
                    spans = _whole_characters(t, spans)
                kept.append(_cut(t, spans))
                total.append(len(t))
                lost.append(len(t) - len(kept[-1]))
                runs.append([{"lo": lo, "hi": hi} for lo, hi in spans])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.binary()), pa.array(total, pa.int64()), pa.array(lost, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))],
                ["row", "kept", "n_bytes", "n_removed", "spans"])

    row = marked.schema["row"].dataType.simpleString()
    return marked.mapInArrow(run, f"row {row}, kept binary, n_bytes long, n_removed long, spans array<struct<lo:long,hi:long>>")


def op5_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_repeats(docs)
    return done.select("row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))
