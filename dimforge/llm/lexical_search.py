"""Ranked lexical search by presence masks.

Every document is ranked for every item of a query set.  A document's
presence mask for an item says which of the item's terms it holds; documents
with the same mask share an upper bound on their score, so masks are
evaluated by descending bound, and once the bound of the next mask is below
the last score of a full list, no document of the remaining masks can enter
it: the search of that item is safely finished.

1. The items' distinct terms are cut into blocks of bounded size (about
   ``BLOCK_TERMS`` pairs of item and term; one block unless the query set is
   large).  A block's terms travel to the tasks; the documents never do.
2. One scan per block counts every document's terms and writes those of the
   block as postings (term number, occurrences).  The number of documents,
   their terms and the document frequencies are sums over that table.
3. The postings are searched in place.  A task holds a bitmap and the term
   contributions of ``CELLS // terms`` documents at a time, packs the bitmaps
   of an item's terms into masks, groups equal masks, and evaluates them by
   descending bound against the best ``k`` of the item so far.  A task hands
   on at most ``k`` rows an item, which are merged in two levels.

A term contributes ``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and
``m = 50 + ((50 * n * N) div L)``: N documents with a term, L their terms, n
the document's, df the documents that hold the term, tf its occurrences.

Defined results
  * null or empty text, or one without terms: no document of N, never ranked;
    such an item has no result;
  * repeated document ids: every row is a document of its own, ranked on its
    own (rows of one id stand by descending score); a null id stands after
    the others of its score;
  * repeated item ids: their terms are united (rows of a null id too), so a
    repeated row changes nothing;
  * fewer than ``k`` documents above 0: all of them; very long texts are
    counted whole;
  * empty tables: empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm._common import LOWER, UPPER, Scratch, read

TOP = 50
#: Pairs of item and term in a block of the query set (on average; at most twice that, or one item).
BLOCK_TERMS = 50_000
#: Cells (term, document) that a task holds at a time.
CELLS = 1 << 22
#: Lists of one item that the first merge level brings together.
FAN_IN = 32

_SPACE = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in range(256))
#: ASCII other than letters and digits to space, A-Z to a-z
_TERMS = _SPACE.translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters."""
    return (text or b"").translate(_TERMS).split()


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, term) of a query set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = set(terms_of(t))
                ids += [i] * len(own)
                out += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["item_id", "term"])

    return items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, "item_id long, term binary").distinct()


class Block:
    """A bounded part of the query set: its terms by number, its items by theirs."""

    def __init__(self, pairs: list[tuple[int | None, bytes]]):
        self.number = {t: k for k, t in enumerate(sorted({t for _, t in pairs}))}
        by_item: dict[int | None, list[int]] = {}
        for i, t in pairs:
            by_item.setdefault(i, []).append(self.number[t])
        self.items = [(i, np.array(sorted(ts), dtype=np.int64)) for i, ts in by_item.items()]


def blocks(terms: DataFrame, block_terms: int) -> Iterator[Block]:
    """The query set in blocks by a hash of the item."""
    total = terms.count()
    n = max(1, math.ceil(total / block_terms))
    while True:
        at = F.pmod(F.xxhash64("item_id"), F.lit(n))
        if n == 1:
            break
        sizes = terms.groupBy(at.alias("at"), "item_id").count().groupBy("at") \
            .agg(F.sum("count").alias("terms"), F.count("*").alias("items"))
        if not sizes.filter((F.col("terms") > 2 * block_terms) & (F.col("items") > 1)).take(1):
            break
        n *= 2
    for k in range(n):
        pairs = [(r.item_id, bytes(r.term)) for r in terms.filter(at == k).collect()]
        if pairs:
            yield Block(pairs)


def postings(docs: DataFrame, number: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms), and the block's terms in the document with their
    occurrences, of every document that has a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ns, ends, at, tf = [], [], [0], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = terms_of(t.as_py())
                if not words:
                    continue
                count = Counter(words)
                held = count.keys() & number.keys()
                ids.append(i)
                ns.append(len(words))
                at += [number[x] for x in held]
                tf += [count[x] for x in held]
                ends.append(len(at))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))], ["doc_id", "n", "at", "tf"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, n long, at array<int>, tf array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def group_masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks of the columns of ``present`` (terms x documents): the
    first column that has each, and every column's group."""
    bits = np.packbits(present, axis=0, bitorder="little")
    bits = np.concatenate([bits, np.zeros((-len(bits) % 8, bits.shape[1]), np.uint8)])
    masks = np.ascontiguousarray(bits.T).view(np.uint64)
    group = np.zeros(len(masks), dtype=np.uint64)
    for word in masks.T:
        _, first, own = np.unique(word, return_index=True, return_inverse=True)
        if not group.any():
            group = own.astype(np.uint64)
        else:
            _, first, group = np.unique(group * np.uint64(len(first)) + own.astype(np.uint64), return_index=True, return_inverse=True)
            group = group.astype(np.uint64)
    return first, group.astype(np.int64)


class Best:
    """The ``k`` best documents of an item so far."""

    def __init__(self, k: int):
        self.k = k
        self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def floor(self) -> int:
        """A score below this one cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        keep = score >= self.floor()
        score, doc, null = (np.concatenate(p) for p in (
            (self.score, score[keep]), (self.doc, doc[keep]), (self.null, null[keep])))
        best = np.lexsort((doc, null, -score))[:self.k]
        self.score, self.doc, self.null = score[best], doc[best], null[best]


def search_item(best: Best, worth: np.ndarray, weights: np.ndarray, doc: np.ndarray, null: np.ndarray) -> int:
    """Adds an item's best documents to ``best``.  ``worth``: contributions
    (terms x documents) before their weights.  Returns the documents scored."""
    present = worth > 0
    first, group = group_masks(present)
    bound = present[:, first].T.astype(np.int64) @ (weights * worth.max(axis=1))
    order = np.argsort(-bound[group], kind="stable")  # documents by the bound of their mask
    ceiling = bound[group][order]
    at, step = 0, 2 * best.k
    while at < len(order) and ceiling[at] >= best.floor():
        # whole masks only: what follows has a lower bound
        end = int(np.searchsorted(-ceiling, -ceiling[min(at + step, len(order)) - 1], side="right"))
        end = min(end, int(np.searchsorted(-ceiling, -best.floor(), side="right")))
        some = order[at:end]
        best.add(weights @ worth[:, some], doc[some], null[some])
        at, step = end, 2 * step
    return at


def search(held: DataFrame, block: Block, n_docs: int, n_terms: int, df: dict[int, int], k: int, cells: int = CELLS) -> DataFrame:
    """The best ``k`` documents of each item in every partition of postings:
    item_id, doc_id, score, part (the partition)."""
    size = len(block.number)
    weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(size)], dtype=np.int64)
    # terms that weigh nothing or occur nowhere add nothing
    items = [(i, ts[(weights[ts] > 0) & np.array([t in df for t in ts.tolist()])]) for i, ts in block.items]
    items = [(i, ts) for i, ts in items if len(ts)]
    width = max(64, cells // max(1, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for b in batches:
            null = ~np.asarray(b.column(0).is_valid())
            doc = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            m = 50 + 50 * b.column(1).to_numpy() * n_docs // n_terms
            ends = b.column(2).offsets.to_numpy()
            term, tf = b.column(2).values.to_numpy(), b.column(3).values.to_numpy()
            for lo in range(0, b.num_rows, width):
                hi = min(lo + width, b.num_rows)
                p = slice(ends[lo], ends[hi])
                at = np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1]))
                worth = np.zeros((size, hi - lo), dtype=np.int64)
                worth[term[p], at] = 1_000_000_000 * tf[p] // (1000 * tf[p] + 20 * m[lo:hi][at])
                for one, (_, ts) in zip(best, items):
                    search_item(one, worth[ts], weights[ts], doc[lo:hi], null[lo:hi])
        for one, (i, _) in zip(best, items):
            if n := len(one.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array([i] * n, pa.int64()), pa.array(one.doc, pa.int64(), mask=one.null),
                    pa.array(one.score, pa.int64())], ["item_id", "doc_id", "score"])

    return held.mapInArrow(run, "item_id long, doc_id long, score long").withColumn("part", F.spark_partition_id())


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: every item's ``k`` best documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    terms = scratch.write(item_terms(items), "terms")
    found = None
    for b, block in enumerate(blocks(terms, block_terms)):
        held = scratch.write(postings(docs, block.number), f"postings-{b}")
        n_docs, n_terms = held.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = {r["at"]: r["count"] for r in held.select(F.explode("at").alias("at")).groupBy("at").count().collect()}
        part = scratch.write(search(held, block, n_docs, n_terms, df, k), f"found-{b}")
        scratch.drop(f"postings-{b}")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item_id long, doc_id long, score long, part int")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = F.row_number().over(Window.partitionBy("item_id", F.pmod(F.xxhash64("part"), F.lit(FAN_IN))).orderBy(*order))
    top = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return (found.withColumn("rank", some).filter(F.col("rank") <= k)
            .withColumn("rank", top).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), n AS (
  SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0
), total AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), occ AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, unnest(terms) AS term FROM n) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * t.docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM occ GROUP BY term), total t
), s AS (
  SELECT q.item_id, o.r, CAST(sum(w.w * ((1000000000 * o.tf) // (1000 * o.tf + 20 * (50 + (50 * n.n * t.docs) // t.terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN occ o USING (term) JOIN n ON n.r = o.r, total t
  GROUP BY q.item_id, o.r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s JOIN (SELECT r, doc_id FROM n) USING (r)
WHERE score > 0
QUALIFY rank <= {TOP}
"""
