"""What Python workers hold at once is bounded in bytes, not only in rows."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimforge.llm import bpe, simhash, substring_dedup, suffix_dedup
from dimforge.llm._anchors import pack
from dimforge.llm._common import BATCH_BYTES, PIECE

SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture()
def unset(spark):
    before = spark.conf.getAll.get(SIZE)
    spark.conf.unset(SIZE)
    yield
    spark.conf.unset(SIZE) if before is None else spark.conf.set(SIZE, before)


def _bytes(df):
    """The sizes of the batches in which a frame's rows reach Python."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])

    return [r.n for r in df.mapInArrow(run, "n long").collect()]


@pytest.mark.parametrize("operator", [suffix_dedup.remove_repeats, substring_dedup.remove_repeats, simhash.keep_one,
                                      lambda docs: bpe.encode(docs, bpe.tokenizer_path())])
def test_batches_are_bounded(spark, unset, operator):
    docs = spark.range(3, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    wide = spark.range(3000, numPartitions=1).select("id", F.repeat(F.lit("x"), 10_000))
    operator(docs)
    sizes = _bytes(wide)
    assert sum(sizes) > 25_000_000 and max(sizes) < 2 * BATCH_BYTES


def test_own_bound_stays(spark, unset):
    spark.conf.set(SIZE, 1 << 20)
    docs = spark.createDataFrame([(1, "a b c " * 50)], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(docs).count() == 1
    assert int(spark.conf.get(SIZE).rstrip("b")) == 1 << 20


def test_pieces_of_open_segments():
    """One batch of few documents makes many segments, and these make many suffixes."""
    unit, step = suffix_dedup.BYTES, suffix_dedup.step_of(100)
    text = bytes(i % 251 for i in range(3 * PIECE + 200))
    found = [int(pack(i, 0, 1)) for i in range(3 * PIECE)]
    docs = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([1, 2], pa.int32()), pa.array([text, text]), pa.array([found, found[:5]])], ["d", "v", "t", "o"])
    out = list(suffix_dedup._segment_texts(unit)(iter([docs])))
    assert max(b.num_rows for b in out) <= 2 * PIECE
    t = pa.Table.from_batches(out)
    assert t.column("x").to_pylist() == [*found, *found[:5]] and t.column("did").to_pylist() == [7] * len(found) + [8] * 5
    assert t.column("text").to_pylist() == [text[i:i + 100] for i in range(len(found))] + [text[i:i + 100] for i in range(5)]

    whole = (unit.length - step + 1) // step
    names = [[j << 8 | j for j in range(whole + 3)]] * 2000
    segments = pa.RecordBatch.from_arrays(
        [pa.array([7] * 2000), pa.array([1] * 2000, pa.int32()), pa.array([int(pack(1000 * i, 70, 60)) for i in range(2000)]),
         pa.array([text[:159]] * 2000), pa.array(names)], ["did", "ver", "x", "text", "found"])
    out = list(suffix_dedup._suffixes(unit, step)(iter([segments])))
    at = [p for b in out for p in b.column(4).to_pylist()]
    assert len(at) > 2 * PIECE and max(b.num_rows for b in out) < PIECE + 100
    assert at == sorted(set(at)) and {p % 1000 for p in at} <= set(range(60))


@pytest.mark.parametrize("digest", [False, True])
def test_encoded_rows_keep_their_ids(spark, digest):
    """Results that leave in several batches belong to the documents they came from."""
    class Docs:
        class sparkSession:  # noqa: N801
            class conf:  # noqa: N801
                getAll = {SIZE: "set"}

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            return run

    texts = ["a b " * (i % 7) * 200 for i in range(1000)] + ["", None]
    run = bpe.encode(Docs(), bpe.tokenizer_path(), digest=digest)
    out = list(run(iter([pa.RecordBatch.from_arrays([pa.array(range(1002)), pa.array(texts)], ["doc_id", "text"])])))
    assert len(out) > 3 and max(sum(b.column(1).to_pylist()) for b in out) * 4 < 2 * bpe.OUT_BYTES
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(1002))
    assert [r["n_tokens"] for r in rows] == [(t or "").count(" ") for t in texts]
    if not digest:
        assert [r["decoded"].count("a") for r in rows] == [(t or "").count("a") for t in texts]
        assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
