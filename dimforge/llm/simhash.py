"""SimHash near-duplicates by a byte-position index with count filtering.

A fingerprint is eight positional bytes.  Two fingerprints that differ in at
most ``max_bits`` bits differ in at most ``max_bits`` of these bytes, so
they share at least ``8 - max_bits`` positional bytes: the guaranteed number
of matches.  The index holds the distinct fingerprints under every
combination of that many byte positions and their values; a pair's tally of
shared bytes reaches the guarantee exactly when the pair meets under a
combination, so the count filter is applied by the key itself and no pair
with fewer matches is ever made.  What remains under a key are the other
``max_bits`` bytes, so a key has at most 256 ** max_bits distinct
fingerprints however large the input is.

Inside a key the fingerprints are linked by flipping up to ``max_bits`` bits
of the remaining bytes and looking the result up (verification is this exact
bit distance).  Only the links of a spanning forest of the key leave the
task, so a group of near copies yields rows in proportion to its members.
Copies count once: equal fingerprints are one node.

Defined results
  * null or empty text, or one without words: fingerprint zero, linked like any other;
  * fewer words than a shingle: the whole sequence is the one shingle;
  * null doc_id: kept as a row of its own; it is linked like any other but
    never the smallest id of a component (a component of null ids only has null);
  * repeated rows: one result row each, in the same component (``keep_one`` keeps one of them);
  * empty table: empty result; extra columns are not read by ``link`` and
    passed through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import LOWER, UPPER, Scratch, bounded_batches, read
from dimforge.llm._graph import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: bits of every byte value, lowest bit first
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """64-bit majority fingerprint of a UTF-8 text."""
    words = (text or b"").translate(_LOWER).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if n <= size:
        hashes = [h(joined, SEED)]
    else:
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends]]
        hashes = [h(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:])]
    a = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    total = len(hashes)
    out = 0
    for byte in range(8):
        ones = np.bincount(a[:, byte], minlength=256) @ _BITS
        for bit in np.flatnonzero(2 * ones > total).tolist():
            out |= 1 << (8 * byte + bit)
    return out


def _fingerprint_of(text: pa.Array, size: int) -> pa.Array:
    fps = np.fromiter((fingerprint(x.as_py(), size) for x in text), dtype=np.uint64, count=len(text))
    return pa.array(fps.view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), _fingerprint_of(b.column(1), size)], ["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, fp long")


def fingerprints_by(rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, mark and fp of rows with a ``key`` (doc_id, mark) and a ``text``."""
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), _fingerprint_of(b.column(2), size)], ["doc_id", "mark", "fp"])

    return rows.select("key.doc_id", "key.mark", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, mark long, fp long")


def index_rows(max_bits: int):
    """Every distinct fingerprint under each combination of kept bytes."""
    kept = list(combinations(range(8), 8 - max_bits))
    masks = np.array([sum(0xFF << (8 * p) for p in c) for c in kept], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for i, m in enumerate(masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), i, np.int32)), pa.array((fp & m).view(np.int64)), pa.array(fp.view(np.int64))],
                    ["combo", "key", "fp"])

    return run


def _flips(max_bits: int, free: list[int]) -> np.ndarray:
    bits = [8 * p + i for p in free for i in range(8)]
    return np.array([sum(1 << b for b in c) for k in range(1, max_bits + 1) for c in combinations(bits, k)], dtype=np.uint64)


def _forest(fps: np.ndarray, flips: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links of the graph on one key's distinct fingerprints."""
    fps = np.unique(fps)
    n = len(fps)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    if n <= len(flips):
        for i in range(n - 1):  # few members: compare directly
            near = i + 1 + np.flatnonzero(np.isin(fps[i + 1:] ^ fps[i], flips))
            pairs.append((np.full(len(near), i), near))
    else:
        for f in flips:
            other = fps ^ f
            at = np.searchsorted(fps, other)
            at[at == n] = 0
            i = np.flatnonzero((fps[at] == other) & (fps < other))
            pairs.append((i, at[i]))
    for x, y in pairs:
        for i, j in zip(x.tolist(), y.tolist()):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, j))
    signed = fps.view(np.int64)
    return [(int(signed[i]), int(signed[j])) for i, j in out]


def key_links(max_bits: int):
    """Links inside every key of partitions sorted by (combo, key).

    A key's members may arrive in several batches; at most 256 ** max_bits of
    them exist, so holding one key is bounded."""
    kept = list(combinations(range(8), 8 - max_bits))
    flips = [_flips(max_bits, [p for p in range(8) if p not in c]) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

        def links(c: np.ndarray, k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
            bounds = np.concatenate(([0], cut, [len(c)]))
            out: list[tuple[int, int]] = []
            for g in np.flatnonzero(np.diff(bounds) > 1).tolist():
                lo, hi = bounds[g], bounds[g + 1]
                out += _forest(f[lo:hi], flips[int(c[lo])])
            a = np.array(out, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

        for b in batches:
            cols = tuple(b.column(i).to_numpy() for i in range(2)) + (b.column(2).to_numpy().view(np.uint64),)
            if held is not None:
                cols = tuple(np.concatenate(p) for p in zip(held, cols))
            c, k, f = cols
            if not len(c):
                continue
            # the last key may go on in the next batch
            start = len(c) - 1 - int(np.argmax(((c != c[-1]) | (k != k[-1]))[::-1])) + 1 if ((c[0] != c[-1]) or (k[0] != k[-1])) else 0
            if start:
                yield links(c[:start], k[:start], f[:start])
            held = (c[start:], k[start:], f[start:])
        if held is not None:
            yield links(*held)

    return run


def _roots(fps: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """fp, first_id, root of every distinct fingerprint; equal roots are one component."""
    per_fp = scratch.write(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "per-fp")
    keys = per_fp.select("fp").mapInArrow(index_rows(max_bits), "combo int, key long, fp long")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (keys.repartition(n, "combo", "key").sortWithinPartitions("combo", "key")
             .mapInArrow(key_links(max_bits), "a long, b long").distinct())
    pairs = scratch.write(pairs, "links")
    comp = components(pairs, scratch)
    rooted = (per_fp.join(comp, per_fp.fp == comp.node, "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    return scratch.write(rooted, "rooted")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.write(fingerprints(docs, id_col, text_col, size), "fps")
    rooted = _roots(fps, max_bits, scratch)
    smallest = scratch.write(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    by_fp = scratch.write(rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id"), "by-fp")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: that with the smallest doc_id (null only if
    the component has no other), of rows that share it the one with the smallest row hash, of
    identical rows one.  Rows are told apart by (doc_id, hash of all columns),
    so an id with two texts loses only the text that repeats another."""
    scratch = Scratch(docs.sparkSession, "simhash")
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(F.struct("doc_id", mark.alias("mark")).alias("key"), "text")
    fps = scratch.write(fingerprints_by(packed, size), "fps")
    rooted = _roots(fps, max_bits, scratch)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    rows = scratch.write(fps.join(rooted.select("fp", "root"), "fp").select("root", "doc_id", "mark"), "rows")
    first = scratch.write(rows.groupBy("root").agg(F.min(order).alias("first")), "first")
    judged = rows.join(first, "root").withColumn("lost", order != F.col("first"))
    keys = scratch.write(judged.groupBy("doc_id", "mark").agg(F.max("lost").alias("lost"), F.count("*").alias("n"))
                         .filter("lost or n > 1").select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "lost"), "keys")
    own = [F.col(f"`{c}`") for c in docs.columns]
    all_rows = docs.select(F.struct(*own).alias("row"), F.col("doc_id").alias("d0"), mark.alias("m0"))

    def meets(part: DataFrame, how: str) -> DataFrame:
        return all_rows.join(part.select("d", "m"), F.col("d0").eqNullSafe(F.col("d")) & (F.col("m0") == F.col("m")), how)

    kept = meets(keys, "left_anti").select("row")
    copies = keys.filter("not lost")
    if copies.take(1):
        kept = kept.unionByName(meets(copies, "left_semi").groupBy("d0", "m0").agg(F.first("row").alias("row")).select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op6_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "documents"))
