"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors (the fit list, n rows, centred) are X.  Each step
multiplies X by the next right vector and its transpose by the left vector
that results, in one job over blocks of rows:

    p = X v_j - sum of u_i (u_i . X v_j) over i < j     (left reorthogonalisation)
    alpha_j = |p|,  u_j = p / alpha_j,  r = X' u_j
    v_j+1 = r reorthogonalised against v_1 .. v_j       (right, twice)

Left vectors are as long as the fit list and are never stored: with V the
right vectors so far and R the small triangular matrix of coefficients,
U R = X V, so a task recovers the left entries of its rows by a triangular
solve against the block it holds.  A lost executor therefore costs its tasks
only.  What leaves a task is one set of sums (X'p, U'p, p.p); the second
left reorthogonalisation follows from those sums.  The driver holds vectors
of the width of the table, never of its length.

After as many steps as the vectors have dimensions the singular value
decomposition of the small matrix gives all components to double
precision.  Where a residual vanishes (fewer directions than dimensions, or equal
singular values) the next right vector is a new one orthogonal to all before.

Sums that must be exact (S, the deviations, the trace) are integers.

Defined results
  * null vector, or null or non-finite entries: the row is dropped, as is one
    with an entry of 2**45 or more in size (64 times it has no exact integer
    arithmetic) or an empty vector;
  * vectors of another length than most (on a tie the longest): dropped, they have no place in one
    covariance;
  * repeated vectors: once in the fit list, a result for every row;
  * repeated or null vec_id: every row has its own results;
  * directions without variance (one distinct vector has none other): no
    component, so there may be fewer than ``k``, or no rows at all;
  * a deviation beyond a long: null;
  * empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import Scratch, read

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
#: Vectors in a block (one row of the written fit list).
BLOCK_ROWS = 4096
SEED = 7
#: A residual below this share of the largest norm is rounding error.
TINY = 1e-12


# -- rows -----------------------------------------------------------------------
def _vectors(col: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, quantised entries without the offset) of the rows that stay."""
    ends, flat = col.offsets.to_numpy(), col.values
    holes = np.asarray(flat.is_null())
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = holes | ~np.isfinite(values) | (np.abs(values) >= 2.0 ** 45)
    wrong = np.concatenate(([0], np.cumsum(bad)))
    there = np.asarray(col.is_valid())
    whole = np.floor(SCALE * np.where(bad, 0, values)).astype(np.int64)
    for i in np.flatnonzero(there & (np.diff(ends) > 0) & (wrong[ends[1:]] == wrong[ends[:-1]])).tolist():
        yield i, whole[ends[i]:ends[i + 1]]


def quantise(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, size, x (entries floor(64 c) as packed longs) of the rows that stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = [], []
            for i, v in _vectors(b.column(1)):
                at.append(i)
                x.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(at, pa.int64())), pa.array([len(v) // 8 for v in x], pa.int32()),
                pa.array(x, pa.binary())], ["vec_id", "size", "x"])

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .mapInArrow(run, "vec_id long, size int, x binary")


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed vectors into blocks of the smallest integer type that holds them."""
    held: list[bytes] = []

    def block() -> pa.RecordBatch:
        x = np.frombuffer(b"".join(held), dtype=np.int64)
        kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max)
        out = [pa.array([len(held)], pa.int64()), pa.array([np.dtype(kind).str], pa.string()), pa.array([x.astype(kind).tobytes()], pa.binary())]
        held.clear()
        return pa.RecordBatch.from_arrays(out, ["n", "kind", "x"])

    for b in batches:
        for v in b.column(0).to_pylist():
            held.append(v)
            if len(held) == BLOCK_ROWS:
                yield block()
    if held:
        yield block()


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for b in batches:
        for kind, x in zip(b.column(1).to_pylist(), b.column(2)):
            yield np.frombuffer(x.as_py(), dtype=kind).reshape(-1, size)


@dataclass
class Fit:
    """The fit list: its blocks, vectors, width and exact sums (without the offset)."""

    blocks: DataFrame
    n: int
    size: int
    sums: list[int]
    squares: int

    def trace(self) -> float:
        """Of the covariance; exact up to the last division."""
        return (self.n * self.squares - sum(s * s for s in self.sums)) / self.n ** 2

    def add_up(self, part, width: int) -> np.ndarray:
        """Sums of ``part(block of centred rows)`` over all blocks."""
        size, centre = self.size, np.array([s / self.n for s in self.sums])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for x in _blocks(batches, size):
                total += part(x - centre)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["at", "s"])

        sums = self.blocks.mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s"))
        out = np.zeros(width)
        for r in sums.collect():
            out[r["at"]] = r["s"]
        return out


def fit_list(kept: DataFrame, size: int, scratch: Scratch) -> Fit:
    """The distinct vectors of ``kept`` and their sums."""
    blocks = scratch.write(kept.select("x").distinct().mapInArrow(pack_blocks, "n long, kind string, x binary"), "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _blocks(batches, size):
            # entries below 2**51 in blocks of 2**12 rows: column sums fit in a long, squares are summed as integers of any size
            sums = x.sum(axis=0, dtype=np.int64)
            small = np.abs(x).max() < 1 << 20 and x.size <= 1 << 22
            squares = int((x.astype(np.int64) ** 2).sum()) if small else sum(v * v for v in x.ravel().tolist())
            yield pa.RecordBatch.from_arrays([pa.array([len(x)]), pa.array([sums.tolist()], pa.list_(pa.int64())),
                                              pa.array([str(squares)])], ["n", "sums", "squares"])

    parts = blocks.mapInArrow(run, "n long, sums array<long>, squares string")
    exact = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(size)]
    n, squares, *sums = parts.agg(F.sum("n"), F.sum(F.col("squares").cast("decimal(38,0)")), *exact).first()
    return Fit(blocks, int(n), size, [int(s) for s in sums], int(squares))


# -- bidiagonalisation ------------------------------------------------------------
def _solve(r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """U of U R = A for an upper triangular R."""
    u = np.empty_like(a)
    for j in range(a.shape[1]):
        u[:, j] = (a[:, j] - u[:, :j] @ r[:j, j]) / r[j, j]
    return u


def bidiagonalise(fit: Fit, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (columns) and the small matrix B of X V = U B."""
    size = fit.size
    rng = np.random.default_rng(seed)
    right: list[np.ndarray] = []
    left: list[np.ndarray] = []  # X'u of every left vector
    cols: list[int] = []  # the right vector that gave it
    b = np.zeros((size, size))
    norm = 0.0

    def orthogonal(r: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for v in right:
                r = r - v * (v @ r)
        return r

    v = rng.standard_normal(size)
    while True:
        v = v / np.linalg.norm(v)
        c = np.array([z @ v for z in left])  # u_i . X v = X'u_i . v
        held, small, k = np.array([right[j] for j in cols]).reshape(-1, size), b[:len(cols), cols], len(cols)

        def part(x: np.ndarray) -> np.ndarray:
            p = x @ v
            if k:
                u = _solve(small, x @ held.T)
                p = p - u @ c
                return np.concatenate(([p @ p], x.T @ p, u.T @ p))
            return np.concatenate(([p @ p], x.T @ p))

        got = fit.add_up(part, 1 + size + k)
        again = got[1 + size:]  # what rounding left along the earlier left vectors
        pp = got[0] - again @ again
        alpha = np.sqrt(max(pp, 0))
        z = got[1:1 + size] - sum((zi * ci for zi, ci in zip(left, again)), np.zeros(size))
        norm = max(norm, float(np.linalg.norm(np.append(c + again, alpha))))
        j = len(right)
        right.append(v)
        b[:k, j] = c + again
        r = np.zeros(size)
        if alpha > TINY * norm:
            b[k, j] = alpha
            left.append(z / alpha)
            cols.append(j)
            r = orthogonal(left[-1])
        if len(right) == size:
            return np.array(right).T, b[:len(cols)]
        if not norm or np.linalg.norm(r) <= TINY * norm:
            r = orthogonal(rng.standard_normal(size))  # the space so far is closed: go on outside it
        v = r


@dataclass
class Whitening:
    """Components (columns, by falling eigenvalue), eigenvalues and the fit list's figures."""

    components: np.ndarray
    eigenvalues: np.ndarray
    n: int
    sums: list[int]
    trace: float
    identity_error: float


def whitening(fit: Fit, k: int = COMPONENTS) -> Whitening:
    right, b = bidiagonalise(fit)
    if len(b):
        _, sigma, w = np.linalg.svd(b, full_matrices=False)
    else:
        sigma, w = np.zeros(0), np.zeros((0, fit.size))
    keep = sigma > 1e-10 * max([*sigma, 0])
    sigma, w = sigma[keep][:k], w[keep][:k]
    parts = right @ w.T
    parts = parts * np.where(parts[np.abs(parts).argmax(axis=0), range(parts.shape[1])] < 0, -1, 1)
    e = sigma ** 2 / fit.n
    out = Whitening(parts, e, fit.n, fit.sums, fit.trace(), 0.0)
    if m := len(e):
        scaled = parts / np.sqrt(e)
        cov = fit.add_up(lambda x: ((y := x @ scaled).T @ y).ravel(), m * m).reshape(m, m) / fit.n
        out.identity_error = float(np.abs(cov - np.eye(m)).max())
    return out


def transform(kept: DataFrame, size: int, model: Whitening) -> DataFrame:
    """A row per vector and component."""
    m, n, sums = len(model.eigenvalues), model.n, np.array(model.sums, dtype=object)
    scaled = model.components / np.sqrt(model.eigenvalues)
    centre = np.array([s / n for s in model.sums])
    explained = model.eigenvalues / model.trace if m else model.eigenvalues
    error = model.identity_error
    # at this size of entries n * x - S and its squares stay within a long
    safe = int(min(2 ** 62 // n, int((2 ** 62 / size) ** 0.5) // n)) - max([abs(int(s)) for s in sums]) // n - 1

    def deviations(x: np.ndarray) -> pa.Array:
        if np.abs(x).max() < safe:
            d = n * x - sums.astype(np.int64)
            return pa.array((d * d).sum(axis=1))
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
        return pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.int64).reshape(-1, size)
            rows, each = len(x), np.repeat(np.arange(len(x)), m)
            white = (x - centre) @ scaled
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * m, n)), deviations(x).take(pa.array(each)), pa.array(white.ravel()),
                pa.array(np.tile(explained, rows)), pa.array(np.full(rows * m, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.select("vec_id", "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(rows: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    scratch = Scratch(rows.sparkSession, "whitening")
    kept = scratch.write(quantise(rows, id_col, vector_col), "kept")
    most = kept.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    size = most["size"] if most else 1
    kept = kept.filter(F.col("size") == size)
    if most:
        model = whitening(fit_list(kept, size, scratch), k)
    else:
        model = Whitening(np.zeros((1, 0)), np.zeros(0), 1, [0], 0.0, 0.0)
    if not len(model.eigenvalues):
        kept = kept.limit(0)
    return transform(kept, size, model)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
