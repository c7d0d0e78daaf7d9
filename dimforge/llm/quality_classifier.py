"""Quality classifier: ordinal cumulative-link regression on hashed text.

Grades are ordered: 0 poor quality, 1 fair (good quality but toxic), 2 good.
One weight vector over hashed tokens is shared by all grades and ordered
thresholds cut its scale: P(grade <= k) = sigmoid(theta_k - w.x).  The model
gives the expected grade and the tail probability P(grade = top), by which
documents are selected.

A document's tokens are runs of letters and runs of other visible
characters, A-Z lower-cased; feature j holds sqrt(share of tokens hashed to
j), so vectors have unit length whatever the length of the text.

The model is fitted on the driver on at most ``MAX_ROWS`` labelled documents
(those whose id has the smallest hash), a fixed bound; their feature rows,
not their texts, are collected.  The weights have a fixed size.  All
documents are scored, whole, in one narrow stage.

Defined results
  * null or empty text: no features, so the grade the thresholds alone give;
  * null labels or ids: the label row is not used; a document with null id is scored;
  * several label rows of a document: the lowest grade counts;
  * no usable labels: weights zero and equally likely grades;
  * repeated rows: each is scored; empty table: empty result;
  * extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import read

GRADES = 3
BUCKETS = 1 << 20
MAX_ROWS = 8_000
STEPS = 600
L1 = 5e-5
#: Least tail probability of a kept document.
KEEP = 0.6

_TOKEN = re.compile(rb"[a-z\x80-\xff]+|[^a-z\x80-\xff\x09-\x0D\x20]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def features(text: bytes | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their values."""
    c = Counter(_TOKEN.findall((text or b"").translate(_LOWER)))
    if not c:
        return np.zeros(0, np.int64), np.zeros(0)
    h = xxhash.xxh32_intdigest
    at = np.fromiter((h(t) for t in c), np.int64, len(c)) % buckets
    n = np.fromiter(c.values(), np.float64, len(c))
    at, where = np.unique(at, return_inverse=True)
    return at, np.sqrt(np.bincount(where, n) / n.sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thetas: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k, one row per score."""
        return _sigmoid(np.asarray(score)[:, None] - self.thetas[None, :])


def fit(rows: np.ndarray, at: np.ndarray, value: np.ndarray, grade: np.ndarray,
        grades: int = GRADES, buckets: int = BUCKETS, steps: int = STEPS, l1: float = L1) -> OrdinalModel:
    """Maximum likelihood with an l1 penalty on the weights (accelerated
    proximal gradient), so that few telling tokens carry the model.

    ``rows, at, value``: the feature matrix as triples; ``grade`` by row."""
    used, col = np.unique(at, return_inverse=True)  # only buckets that occur
    n, d = len(grade), len(used)
    theta = np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1))
    if not n or not d:
        return OrdinalModel(np.zeros(buckets), theta)
    x = np.ones(d)  # step length from the largest eigenvalue of X'X / n
    for _ in range(15):
        x = np.bincount(col, value * np.bincount(rows, value * x[col], minlength=n)[rows], minlength=d)
        largest = np.linalg.norm(x)
        x /= largest
    step = 2.0 * n / largest
    idx = np.arange(n)
    w, z, t = np.zeros(d), np.zeros(d), 1.0
    for _ in range(steps):
        s = np.bincount(rows, value * z[col], minlength=n)
        edge = np.concatenate((np.zeros((n, 1)), _sigmoid(theta[None, :] - s[:, None]), np.ones((n, 1))), axis=1)
        hi, lo = edge[idx, grade + 1], edge[idx, grade]
        like = np.maximum(hi - lo, 1e-12)
        up, down = hi * (1 - hi) / like / n, lo * (1 - lo) / like / n
        g_theta = (np.bincount(grade, down, minlength=grades + 1)[1:grades]
                   - np.bincount(grade + 1, up, minlength=grades + 1)[1:grades])
        new = z - step * np.bincount(col, value * (up - down)[rows], minlength=d)
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + (before - 1) / t * (new - w), new
        theta = np.maximum.accumulate(theta - g_theta)
    weights = np.zeros(buckets)
    weights[used] = w
    return OrdinalModel(weights, theta)


def grades_of(labels: DataFrame) -> DataFrame:
    """doc_id and grade of every usable label."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.min(grade).alias("grade")))


def train(docs: DataFrame, grades: DataFrame, max_rows: int = MAX_ROWS, buckets: int = BUCKETS,
          steps: int = STEPS, text_col: str = "text") -> OrdinalModel:
    """Fit on at most ``max_rows`` graded documents and at most as many rows
    of them: rows that share a graded id stand in the order of their text's hash."""
    some = grades.select("doc_id", "grade").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [features(t.as_py(), buckets) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in f], pa.list_(pa.int32())), pa.array([x for _, x in f], pa.list_(pa.float32())),
                 b.column(1).cast(pa.int32()), b.column(2).cast(pa.int64()), b.column(3)], ["at", "value", "grade", "doc_id", "mark"])

    # the sample has a fixed bound, so it may be broadcast
    got = (docs.select("doc_id", F.col(text_col).cast("binary").alias("text")).join(F.broadcast(some), "doc_id")
           .select("text", "grade", "doc_id", F.xxhash64("text").alias("mark"))
           .mapInArrow(run, "at array<int>, value array<float>, grade int, doc_id long, mark long")
           .orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(max_rows)
           .toArrow().sort_by([("doc_id", "ascending"), ("mark", "ascending")]))
    at, value = got.column("at").combine_chunks(), got.column("value").combine_chunks()
    sizes = np.diff(at.offsets.to_numpy()) if len(at) else np.zeros(0, int)
    return fit(np.repeat(np.arange(len(sizes)), sizes), at.flatten().to_numpy().astype(np.int64),
               value.flatten().to_numpy().astype(np.float64), got.column("grade").to_numpy().astype(np.int64),
               buckets=buckets, steps=steps)


def classify(docs: DataFrame, model: OrdinalModel, keep: float = KEEP,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = np.zeros(b.num_rows)
            for i, t in enumerate(b.column(1)):
                at, x = features(t.as_py(), len(m.weights))
                s[i] = m.weights[at] @ x
            above = m.above(s)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(above.sum(1)), pa.array(above[:, -1]), pa.array(above[:, -1] >= keep)],
                ["doc_id", "expected_grade", "tail_probability", "kept"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return classify(docs, train(docs, grades_of(read(spark, sf_dir, "labels"))))
