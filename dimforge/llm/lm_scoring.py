"""LM scoring: cross-entropy difference of two matched n-gram models.

A target model (documents labelled as good) and a background model (all
documents) are counted over the whole corpus.  They are matched: one shared
vocabulary, the same order, the same smoothing.  A document's score is the
mean over its tokens of target loss minus background loss; low scores look
like the target (Moore and Lewis, 2010).

p(w|v) = (c(v,w) + mu * p(w)) / (c(v) + mu), with p(w) the add-one unigram
estimate over all words and one unknown token; the first token of a document
follows a start token.

Every word and every bigram is counted under its own key, in tables that
grow with the corpus; nothing of the corpus but three sums reaches the
driver.  Documents are taken in chunks of about ``CHUNK`` tokens.  A chunk
asks for the counts of its distinct words, contexts and bigrams (at most one
row per key and chunk, so no key is hot), dealt to buckets by a hash of the
key; a bucket sums its keys, compared in full, over all chunks and answers in
the order asked; the chunk is scored with its answers.  The number of buckets
follows the bytes of text, so a bucket's keys are as many at any size; how
many chunks ask for a frequent one grows.  Beyond ``FAN_IN`` chunks the
questions of a bucket are therefore summed in groups of chunks, the groups
asked the same way, and their answers handed back down: no task ever reads more than
``FAN_IN`` rows of one bucket.

Two passes over the texts: their size, and the numbered words (this pass joins
the labels).  Keys and scores are made from the written chunks.  Nothing is
sampled.

Defined results
  * null or empty text: no tokens, score 0, ``n_tokens`` 0;
  * no labelled target documents: the target model is the uniform
    unigram distribution, scores are still defined;
  * null label values: the row is not a target;
  * a document with several label rows is a target if one of them is;
  * repeated rows: counted and scored each; null ids: counted and scored;
  * empty corpus: empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import Scratch, read

MU = 64.0
#: Tokens of the documents that are scored together, and bytes of text a bucket of keys.
CHUNK = 4_000_000
BUCKET = 1 << 22
#: Rows of a bucket that are summed in one task.
FAN_IN = 512
#: Stands for the start of a document; words hold no white space.
START = b"\t"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _pack(x) -> bytes:
    """Bytes or an array of counts, compressed; the length leads."""
    if not isinstance(x, bytes):
        x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
        x = bytes([x.itemsize]) + x.tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(x, codec="zstd", asbytes=True)


def _unpack(x: bytes) -> bytes:
    return pa.decompress(x[8:], decompressed_size=int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)


def _numbers(x: bytes) -> np.ndarray:
    raw = _unpack(x)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in lower case (A to Z), and how many each text has."""
    texts = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, parent = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)
    n = np.bincount(parent.filter(some).to_numpy(), minlength=len(texts))
    return words.filter(some).cast(pa.binary()), n


@dataclass
class _Chunk:
    """Words by number (0 is the start) and what documents of ``sizes`` words ask for.

    Keys are the words, the contexts and the distinct bigrams (``before``,
    ``after``), in this order; ``pair`` is the bigram of each word and ``asked``
    the keys that occur, by bucket."""

    ids: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray
    buckets: int

    def __post_init__(self):
        size = self.size = len(self.hashes)
        last = np.concatenate(([0], self.ids[:-1])) if len(self.ids) else self.ids.copy()
        last[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = 0
        self.last = last
        pairs, pair = np.unique(last * size + self.ids, return_inverse=True)
        self.pair = pair.reshape(-1)
        self.before, self.after = pairs // size, pairs % size
        h = self.hashes.astype(np.uint64)
        none = np.zeros(size, dtype=np.uint64)
        x = (np.concatenate((none, h, h[self.before])) * np.uint64(0x100000001B3)) ^ np.concatenate((h, none, h[self.after]))
        x = (x ^ (x >> np.uint64(29))) * _MIX
        bucket = ((x ^ (x >> np.uint64(32))) % np.uint64(self.buckets)).astype(np.min_scalar_type(self.buckets))
        self.n = self.counts(slice(None))
        at = np.argsort(bucket, kind="stable")
        # the start is no word, and the last words of documents may be no context
        self.asked = at[self.n[at] > 0]
        # the buckets that occur, and where their keys end
        self.which, first = np.unique(bucket[self.asked], return_index=True)
        self.ends = np.append(first, len(self.asked))

    def counts(self, pick) -> np.ndarray:
        return np.concatenate([np.bincount(x[pick], minlength=m) for x, m in (
            (self.ids, self.size), (self.last, self.size), (self.pair, len(self.before)))])


_CHUNKS = pa.schema([("chunk", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("target", pa.list_(pa.bool_())),
                     ("targets", pa.int64()), ("ids", pa.binary()), ("hashes", pa.binary()), ("words", pa.binary()), ("lengths", pa.binary())])
_ASKED = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("lengths", pa.binary()),
                    ("n", pa.binary()), ("t", pa.binary())])


def _row(schema: pa.Schema, **x) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[f.name]], f.type) for f in schema], schema=schema)


def _pack_strings(x: pa.Array) -> tuple[bytes, bytes]:
    ends = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1]
    return _pack(x.buffers()[2][ends[0]:ends[-1]].to_pybytes()), _pack(np.diff(ends))


def _strings(data: bytes, lengths: bytes) -> pa.Array:
    n = _numbers(lengths)
    ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(_unpack(data))])


def _chunk_row(chunk: int, docs: list, sizes: np.ndarray, target: list, words: pa.Array) -> pa.RecordBatch:
    coded = words.dictionary_encode()
    names = pa.concat_arrays([pa.array([START], pa.binary()), coded.dictionary])
    hashes = np.fromiter(map(zlib.crc32, names.to_pylist()), np.uint32, len(names))
    good = int(sizes[np.array(target, dtype=bool)].sum())
    data, lengths = _pack_strings(names)
    return _row(_CHUNKS, chunk=chunk, docs=docs, sizes=sizes.tolist(), target=target, targets=good,
                ids=_pack(coded.indices.to_numpy().astype(np.int64) + 1), hashes=_pack(hashes), words=data, lengths=lengths)


def chunks_of(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Numbered words of the documents (doc_id, text in bytes, target), a row a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = TaskContext.get().partitionId() << 32, 0
        ids, sizes, target, words = [], [], [], []
        for b in batches:
            # a batch is cut at every ``chunk`` bytes, so a piece has fewer words and one document more
            piece = np.cumsum(pc.binary_length(b.column(1)).to_numpy().astype(np.int64)) // chunk
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                w, n = _words(b.column(1).slice(lo, hi - lo))
                ids += b.column(0).slice(lo, hi - lo).to_pylist()
                target += b.column(2).slice(lo, hi - lo).to_pylist()
                sizes.append(n)
                words.append(w)
                held += len(w) + hi - lo
                if held >= chunk:
                    yield _chunk_row(at, ids, np.concatenate(sizes), target, pa.concat_arrays(words))
                    ids, sizes, target, words = [], [], [], []
                    at, held = at + 1, 0
        if ids:
            yield _chunk_row(at, ids, np.concatenate(sizes), target, pa.concat_arrays(words))

    return docs.mapInArrow(run, "chunk long, docs array<long>, sizes array<long>, target array<boolean>, targets long, "
                                "ids binary, hashes binary, words binary, lengths binary")


def ask(chunks: DataFrame, buckets: int) -> DataFrame:
    """The keys of every chunk with its own counts, a row a bucket.

    Keys: b"v w" a bigram, b"v " a context, b" w" a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = pa.scalar(b" ", pa.binary())
        for b in batches:
            for k in range(b.num_rows):
                row = {f.name: b.column(i)[k].as_py() for i, f in enumerate(b.schema)}
                sizes = np.array(row["sizes"], dtype=np.int64)
                c = _Chunk(_numbers(row["ids"]), sizes, _numbers(row["hashes"]), buckets)
                t = c.counts(np.repeat(np.array(row["target"], dtype=bool), sizes))
                # the number after the last word's is nothing
                names = pa.concat_arrays([_strings(row["words"], row["lengths"]), pa.array([b""], pa.binary())])
                name, none = np.arange(c.size), np.full(c.size, c.size)
                first, second = np.concatenate((none, name, c.before)), np.concatenate((name, none, c.after))
                for g, lo, hi in zip(c.which.tolist(), c.ends[:-1].tolist(), c.ends[1:].tolist()):
                    x = c.asked[lo:hi]
                    keys, lengths = _pack_strings(pc.binary_join_element_wise(
                        names.take(pa.array(first[x])), names.take(pa.array(second[x])), space))
                    yield _row(_ASKED, chunk=row["chunk"], bucket=g, keys=keys, lengths=lengths, n=_pack(c.n[x]), t=_pack(t[x]))

    return (chunks.select("chunk", "sizes", "target", "ids", "hashes", "words", "lengths")
            .mapInArrow(run, "chunk long, bucket long, keys binary, lengths binary, n binary, t binary"))


_ANSWERS = "chunk long, bucket long, words long, n binary, t binary"


def _coded(asked: pa.Table) -> tuple[pa.Table, pa.DictionaryArray, np.ndarray]:
    """Rows of one bucket by chunk, their keys by number, and where each row's keys end."""
    asked = asked.sort_by("chunk")
    parts = [_strings(k.as_py(), n.as_py()) for k, n in zip(asked.column("keys"), asked.column("lengths"))]
    return asked, pa.concat_arrays(parts).dictionary_encode(), np.cumsum([len(p) for p in parts])


def _totals(asked: pa.Table, coded: pa.DictionaryArray, column: str) -> np.ndarray:
    """The sum of every key (below 2^53: exact)."""
    asks = np.concatenate([_numbers(x.as_py()) for x in asked.column(column)])
    return np.bincount(coded.indices.to_numpy(), asks, minlength=len(coded.dictionary)).astype(np.int64)


def _handed_back(asked: pa.Table, coded: pa.DictionaryArray, ends: np.ndarray, words: int, totals: dict[str, np.ndarray]) -> pa.Table:
    """For each chunk the totals of its keys in the order asked."""
    at = coded.indices.to_numpy()
    out = {"chunk": asked.column("chunk").combine_chunks(), "bucket": asked.column("bucket").combine_chunks(),
           "words": pa.array([words] * len(ends), pa.int64())}
    for c, total in totals.items():
        out[c] = pa.array([_pack(x) for x in np.split(total[at], ends[:-1])], pa.binary())
    return pa.table(out)


def _answer(asked: pa.Table) -> pa.Table:
    """All rows of one bucket: its keys summed over the chunks, for each chunk in the order asked."""
    asked, coded, ends = _coded(asked)
    words = pc.sum(pc.starts_with(coded.dictionary, b" ")).as_py()
    return _handed_back(asked, coded, ends, words, {c: _totals(asked, coded, c) for c in ("n", "t")})


def _summed(key: tuple, asked: pa.Table) -> pa.Table:
    """The rows of a bucket from one group of chunks as one row of that group."""
    asked, coded, _ = _coded(asked)
    keys, lengths = _pack_strings(coded.dictionary)
    n, t = (_pack(_totals(asked, coded, c)) for c in ("n", "t"))
    return pa.Table.from_batches([_row(_ASKED, chunk=key[1].as_py(), bucket=key[0].as_py(), keys=keys, lengths=lengths, n=n, t=t)])


def _passed_on(asked: pa.Table, above: pa.Table) -> pa.Table:
    """A group's answer (one row, keys in the order of ``_summed``) for each of its chunks."""
    asked, coded, ends = _coded(asked.select([f.name for f in _ASKED]))
    totals = {c: _numbers(above.column(c)[0].as_py()) for c in ("n", "t")}
    return _handed_back(asked, coded, ends, above.column("words")[0].as_py(), totals)


def answered(asked: DataFrame, chunks: int, fan_in: int, scratch: Scratch, level: int = 0) -> DataFrame:
    """Every question with the totals of its keys (columns of ``_ANSWERS``); ``asked`` is a written table."""
    if chunks <= fan_in:
        return asked.groupBy("bucket").applyInArrow(_answer, _ANSWERS)
    groups = -(-chunks // fan_in)
    part = F.pmod(F.xxhash64(F.lit(level), "chunk"), F.lit(groups)).alias("part")
    rows = asked.select("*", part)
    above = scratch.write(rows.groupBy("bucket", "part").applyInArrow(
        _summed, "chunk long, bucket long, keys binary, lengths binary, n binary, t binary"), f"asked-{level + 1}")
    above = scratch.write(answered(above, groups, fan_in, scratch, level + 1), f"answers-{level + 1}")
    return rows.groupBy("bucket", "part").cogroup(above.withColumnRenamed("chunk", "part").groupBy("bucket", "part")).applyInArrow(
        _passed_on, _ANSWERS)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, mu: float = MU, chunk: int = CHUNK, bucket: int = BUCKET,
                             fan_in: int = FAN_IN) -> DataFrame:
    """Scores of all documents by models of all words and bigrams."""
    scratch = Scratch(docs.sparkSession, "lm-scoring")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // bucket + 1
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    chunks = scratch.write(chunks_of(mark_target(text, labels, "doc_id").select(
        "doc_id", "text", F.coalesce("target", F.lit(False))), chunk), "chunks")
    scratch.release()
    asked, n_chunks = ask(chunks, buckets), chunks.count()
    if n_chunks > fan_in:  # read at every level
        asked = scratch.write(asked, "asked-0")
    answers = scratch.write(answered(asked, n_chunks, fan_in, scratch), "answers")
    scratch.release()
    # three numbers: tokens of both corpora, and words
    tokens = chunks.agg(F.sum("targets"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    words = answers.groupBy("bucket").agg(F.max("words").alias("words")).agg(F.sum("words")).first()[0] or 0
    totals = [x or 0 for x in tokens]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {k: left.column(k)[0].as_py() for k in ("docs", "sizes", "ids", "hashes")}
        sizes = np.array(row["sizes"], dtype=np.int64)
        c = _Chunk(_numbers(row["ids"]), sizes, _numbers(row["hashes"]), buckets)
        right = right.sort_by("bucket")
        doc = np.repeat(np.arange(len(sizes)), sizes)
        means = []
        for k, total in zip(("t", "n"), totals):
            counts = np.zeros(len(c.n))
            if len(c.asked):
                counts[c.asked] = np.concatenate([_numbers(x.as_py()) for x in right.column(k)])
            base = (counts[c.after] + 1.0) / (total + words + 1)
            loss = -np.log((counts[2 * c.size:] + mu * base) / (counts[c.size + c.before] + mu))
            means.append(np.bincount(doc, loss[c.pair], minlength=len(sizes)) / np.maximum(sizes, 1))
        a, b = means
        return pa.table({"doc_id": pa.array(row["docs"], pa.int64()), "n_tokens": pa.array(sizes), "target_loss": pa.array(a),
                         "background_loss": pa.array(b), "score": pa.array(a - b)})

    return chunks.select("chunk", "docs", "sizes", "ids", "hashes").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def mark_target(docs: DataFrame, labels: DataFrame, *more: str) -> DataFrame:
    """text and ``target`` of every document: good quality and not toxic."""
    good = (labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
            .select("doc_id").distinct().withColumn("target", F.lit(True)))
    # labels grow with the corpus: the same join at every size, never a broadcast
    return docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left").select(*more, "text", "target")


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
