"""Substring dedup by seed and extend.

Seeds are winnowed anchors (grams of ``GRAM`` words): every window of
``LENGTH`` words selects one, so documents that share a window meet when
they are joined on their anchors.  A seed is extended both ways over the
words whose windows select it.  Seeds whose whole extensions are equal form
one class and all but its first member are repeats at once.  Where extensions
of a seed differ, it is extended window by window: a words to the left and b
to the right, a + b = LENGTH - GRAM, and windows with equal words are
compared by their starts.  Runs of covered windows merge to maximal repeats
of at least ``LENGTH`` words.

A passage shared by many documents is never paired up: equal extensions are
aggregated before they are shuffled, and every repeat is compared with the
earliest occurrence only (earlier: smaller doc_id, or same document and
earlier start).  All joins are on written tables, so Spark can split a hot
anchor.

Defined results
  * null or empty text, fewer words than LENGTH: nothing removed;
  * null doc_id: sorts before all others; rows sharing a doc_id: see ``_anchors``;
  * identical rows (same id and text) are one document and get the same result;
  * empty table: empty result; extra columns pass through ``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._anchors import Repeats, Unit, merged, unpack
from dimforge.llm._common import read

LENGTH = 20
GRAM = 8
WORDS = Unit(LENGTH, GRAM, words=True)


def _extensions(unit: Unit):
    """(key, did, p, ver) of every window of the open segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            for did, ver, text, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                _, content = unit.cut(text.as_py())
                starts = sorted({p for x in found for p in range(x >> 16, (x >> 16) + unpack(x)[2])})
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(content(p, p + unit.length)) for p in starts], pa.binary()), pa.array([did] * n, pa.int64()),
                     pa.array(starts, pa.int64()), pa.array([ver] * n, pa.int32())], ["key", "did", "p", "ver"])

    return run


def find_repeats(docs: DataFrame, unit: Unit = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, text, ranges: covered word ranges [lo, hi) of every document (may overlap)."""
    r = Repeats(docs, unit, "substring-dedup", id_col, text_col)
    r.prepare()
    windows = r.scratch.write(r.open_texts(_extensions(unit), "key binary, did long, p long, ver int"), "windows")
    first = (windows.groupBy("key").agg(F.min(F.struct("did", "p")).alias("first"), F.max(F.struct("did", "p")).alias("last"))
             .filter(F.col("first") < F.col("last")).select("key", "first"))
    first = r.scratch.write(first, "first")
    later = windows.join(first, "key").filter(F.struct("did", "p") > F.col("first"))
    partly = later.select("did", "ver", F.col("p").alias("lo"), (F.col("p") + unit.length).alias("hi"))
    return r.spans(r.covered_whole().unionByName(partly))


def remove_repeats(docs: DataFrame, unit: Unit = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input columns with the text's kept words joined by single spaces,
    and ``n_words``, ``n_removed``, ``spans`` (maximal covered runs of words)."""
    marked = find_repeats(docs, unit, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, total, lost, runs = [], [], [], []
            for t, spans in zip(b.column(1), merged(b.column(2))):
                words = t.as_py().split()
                out, at = [], 0
                for lo, hi in spans:
                    out += words[at:lo]
                    at = hi
                out += words[at:]
                kept.append(b" ".join(out))
                total.append(len(words))
                lost.append(len(words) - len(out))
                runs.append([{"lo": lo, "hi": hi} for lo, hi in spans])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.binary()), pa.array(total, pa.int64()), pa.array(lost, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))],
                ["row", "kept", "n_words", "n_removed", "spans"])

    row = marked.schema["row"].dataType.simpleString()
    return marked.mapInArrow(run, f"row {row}, kept binary, n_words long, n_removed long, spans array<struct<lo:long,hi:long>>")


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_repeats(docs)
    return done.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
