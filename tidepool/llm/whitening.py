"""Whitening of embeddings: the leading principal components, by contour integration (FEAST).

1. Spark turns entries into integers, keeps each distinct vector once (the fit list, written), sums its dimensions
   exactly and its covariance in blocks: every task centres its vectors before it multiplies them, and only
   one matrix a task is left to add up.
2. The covariance, ``dim`` x ``dim`` whatever the number of rows, is decomposed in the driver. Inertia counts
   (the signs of a symmetric factorisation of V - s I count the eigenvalues above s) find by bisection an
   interval that holds the leading eigenvalues. A contour around it is integrated by Gauss-Legendre quadrature: at
   each node a complex shifted system is solved, and the weighted sum projects a block of vectors onto the
   interval's eigenvectors. Rayleigh-Ritz extracts them, and this is repeated until the residuals vanish.
   The inertia of both ends then says whether one is missing; if so, the block grows.
3. Every row is projected; the covariance of the projected fit list shows how far the result is from white.

Defined cases: a vector that is null, or has a null or non-finite entry or one of magnitude ``LARGEST`` or more (its
integer would not be exact), is left out; so are empty vectors and those whose length is not the commonest (of
equally common ones the greatest). Repeated rows and rows with null ids are kept. Components end where
eigenvalues vanish against the trace (fewer distinct vectors than dimensions, for example), so one distinct
vector or an empty table gives no rows. The sum of squares ``deviation`` is exact; null if it does not fit a long.
A row's columns ride in the struct ``row``, so no name can clash. Tied eigenvalues give some orthonormal basis of their space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from tidepool.llm.common import query, read, written

SCALE, COMPONENTS, SEED = 256, 4, 42
#: Entries of this magnitude are not used: their integers must be exact as doubles.
LARGEST = float(1 << 44)
#: Quadrature nodes on the upper half of the contour, rounds, and the residual (against the norm) that ends them.
NODES, ROUNDS, RESIDUAL = 12, 40, 1e-13
#: An eigenvalue below this share of the trace counts as none.
LEAST_SHARE = 1e-12


# Decomposition of a symmetric matrix


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """The numbers of positive, negative and zero eigenvalues of a symmetric matrix.

    By Sylvester's law they are those of the block diagonal factor of L D L', which is found with pivots of one or two rows (Bunch and Parlett).
    """
    a = np.array(a, np.float64)
    n, tiny = len(a), np.finfo(float).eps * np.abs(a).max(initial=0.0)
    bound = (1 + np.sqrt(17)) / 8
    positive = negative = 0
    k = 0
    while k < n:
        part = a[k:, k:]
        diagonal = np.abs(np.diagonal(part))
        i = int(np.argmax(diagonal))
        off = np.abs(part - np.diag(np.diagonal(part)))
        largest = off.max(initial=0.0)
        if max(diagonal[i], largest) <= tiny:
            break
        if diagonal[i] >= bound * largest:
            _exchange(a, k, k + i)
            pivot = a[k, k]
            positive, negative = positive + (pivot > 0), negative + (pivot < 0)
            column = a[k + 1:, k].copy()
            a[k + 1:, k + 1:] -= np.outer(column, column / pivot)
            k += 1
        else:
            p, q = sorted(np.unravel_index(int(np.argmax(off)), off.shape))
            _exchange(a, k, k + p)
            _exchange(a, k + 1, k + q)
            # Its determinant is negative: one eigenvalue of each sign.
            positive, negative = positive + 1, negative + 1
            columns = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= columns @ np.linalg.solve(a[k:k + 2, k:k + 2], columns.T)
            k += 2
    return positive, negative, n - positive - negative


def _exchange(a: np.ndarray, i: int, j: int) -> None:
    a[[i, j]] = a[[j, i]]
    a[:, [i, j]] = a[:, [j, i]]


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` are above ``shift``."""
    return inertia(a - shift * np.eye(len(a)))[0]


def leading_interval(a: np.ndarray, count: int) -> tuple[float, float, int]:
    """An interval that holds the ``count`` largest eigenvalues of ``a``, and how many it holds.

    More than ``count`` where eigenvalues tie. The lower end is the middle of the gap below them.
    """
    reach = float(np.abs(a).sum(axis=1).max(initial=0.0))
    low, high, found = -reach * (1 + 1e-6) - 1e-300, reach * (1 + 1e-6) + 1e-300, len(a)
    resolution = 1e-12 * reach
    inside, outside = low, high  # above(inside) >= count > above(outside)
    while outside - inside > resolution and found != count:
        middle = (inside + outside) / 2
        n = above(a, middle)
        if n >= count:
            inside, found = middle, n
        else:
            outside = middle
    # Both ends of the gap around ``inside``, closely enough to take a point well inside it.
    below, bottom, top, beyond = low, inside, inside, outside
    while max(bottom - below, beyond - top) > max((top - bottom) / 8, resolution):
        if bottom - below > beyond - top:
            middle = (below + bottom) / 2
            below, bottom = (middle, bottom) if above(a, middle) > found else (below, middle)
        else:
            middle = (top + beyond) / 2
            top, beyond = (top, middle) if above(a, middle) < found else (middle, beyond)
    return (bottom + top) / 2, high, found


def contour(low: float, high: float, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights on the upper half of the circle around [low, high]; the real part of the sum is twice the half's."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - x)
    radius = (high - low) / 2
    turn = np.exp(1j * angle)
    return (low + high) / 2 + radius * turn, w * radius * turn / 2


def project(a: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """``block`` projected onto the eigenvectors of ``a`` whose eigenvalues lie in the interval, nearly."""
    out = np.zeros_like(block)
    for z, w in zip(*contour(low, high)):
        out += np.real(w * np.linalg.solve(z * np.eye(len(a)) - a, block.astype(complex)))
    return out


def feast(a: np.ndarray, low: float, high: float, count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of ``a`` in [low, high], falling, and their unit eigenvectors as columns; ``count`` of them are expected."""
    n, norm = len(a), float(np.abs(a).sum(axis=1).max(initial=0.0)) or 1.0
    size = min(n, max(count + 4, 2 * count))
    while True:
        block = np.random.default_rng(seed).standard_normal((n, size))
        for _ in range(ROUNDS):
            basis, _ = np.linalg.qr(project(a, block, low, high))
            values, vectors = np.linalg.eigh(basis.T @ a @ basis)
            block = basis @ vectors
            held = (values >= low) & (values <= high)
            residual = np.linalg.norm(a @ block[:, held] - block[:, held] * values[held], axis=0).max(initial=0.0)
            if held.sum() == count and residual <= RESIDUAL * norm:
                break
        # The same number as by inertia: none is missed, none is there twice.
        if held.sum() == count and residual <= 1e4 * RESIDUAL * norm:
            order = np.flatnonzero(held)[::-1]
            return values[order], block[:, order]
        if size == n:
            raise ArithmeticError(f"{int(held.sum())} of {count} eigenvalues found, residual {residual}")
        size = min(n, 2 * size)


def leading(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``count`` largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns; those that vanish are left out."""
    trace = float(np.trace(a)) if len(a) else 0.0
    if not trace > 0:
        return np.zeros(0), np.zeros((len(a), 0))
    scaled = a / trace
    count = min(count, above(scaled, LEAST_SHARE))
    low, high, held = leading_interval(scaled, count)
    values, vectors = feast(scaled, low, high, held)
    values, vectors = values[:count], vectors[:, :count]
    keep = values > LEAST_SHARE
    # The sign: the largest entry is positive.
    vectors = vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[keep] * trace, vectors * signs


# Sums over rows


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def integers(vectors: DataFrame, vector_col: str = "embedding", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """row (the columns ``carry``) and x, the integers floor(SCALE * entry), of rows whose vector can be used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            present = column.is_valid().to_numpy(zero_copy_only=False)
            rows = column.filter(pa.array(present))
            flat = rows.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is NaN here
            lengths = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(len(rows)), lengths)
            bad = np.bincount(of[~(np.abs(flat) < LARGEST)], minlength=len(rows)) > 0
            keep = ~bad & (lengths > 0)
            x = np.floor(SCALE * flat[keep[of]]).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths[keep])]).astype(np.int32)
            where = np.flatnonzero(present)[keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))], names=["row", "x"])

    rows = vectors.select(F.struct(*carry).alias("row"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("x", ArrayType(LongType()))]))


def _summed(rows: DataFrame, kind: str, of_batch, size: int) -> np.ndarray:
    """The sum of ``of_batch`` (``size`` numbers) over all batches of a column of vectors: added up in each task, then over tasks."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype)
        for batch in batches:
            if batch.num_rows:
                total += of_batch(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "v"])

    out = np.zeros(size, dtype)
    for r in rows.mapInArrow(run, f"at long, v {kind}").groupBy("at").agg(F.sum("v").alias("v")).collect():  # ``size`` rows
        out[r["at"]] = r.v
    return out


def covariance(rows: DataFrame, n: int, dim: int, centred) -> np.ndarray:
    """The covariance, divisor ``n``, of the vectors that ``centred`` makes of the rows' column x."""
    upper = np.triu_indices(dim)

    def of_batch(column: pa.Array) -> np.ndarray:
        c = centred(column)
        return (c.T @ c)[upper]

    out = np.zeros((dim, dim))
    out[upper] = _summed(rows, "double", of_batch, len(upper[0])) / n
    return np.triu(out) + np.triu(out, 1).T


# The operator


@dataclass
class Whitening:
    """What :func:`fit` learns: n fit vectors with sums S, and the components (columns) with their eigenvalues."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / self.n) @ (self.vectors / np.sqrt(self.values))


def fit(x: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, int]:
    """The whitening of the distinct vectors of ``x`` and their length; None if there is no component."""
    common = (x.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first())
    if common is None:
        return None, 0
    dim = common.dim
    # Copies fall together before the shuffle, whatever their number.
    fits = written(x.filter(F.size("x") == dim).select("x").distinct(), "fit")
    totals = _summed(fits, "long", lambda c: np.append(_matrix(c, dim).sum(axis=0), len(c)), dim + 1)
    n, sums = int(totals[-1]), totals[:-1]
    mean = sums / n
    v = covariance(fits, n, dim, lambda c: _matrix(c, dim) - mean)
    values, vectors = leading(v, components)
    if not len(values):
        return None, dim
    model = Whitening(n, sums, float(np.trace(v)), values, vectors, 0.0)
    k = len(values)
    mean_white = _summed(fits, "double", lambda c: model.project(_matrix(c, dim)).sum(axis=0), k) / n
    white = covariance(fits, n, k, lambda c: model.project(_matrix(c, dim)) - mean_white)
    model.identity_error = float(np.abs(white - np.eye(k)).max())
    return model, dim


def deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """For each row the sum of (n * x - S)^2, exactly; None if it is no long."""
    largest = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if largest * largest * max(x.shape[1], 1) < 1 << 62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def transform(x: DataFrame, model: Whitening | None, dim: int) -> DataFrame:
    """For each row of :func:`integers` and component: row, component, n, deviation, whitened, explained, identity_error."""
    schema = StructType([x.schema["row"], StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType()),
                         StructField("whitened", DoubleType()), StructField("explained", DoubleType()), StructField("identity_error", DoubleType())])
    if model is None:
        return x.sparkSession.createDataFrame([], schema)
    k, share = len(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, m = _matrix(batch.column(1), dim), batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                pa.array([d for d in deviation(rows, model.n, model.sums) for _ in range(k)], pa.int64()),
                pa.array(model.project(rows).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, model.identity_error))],
                names=schema.names)

    return x.filter(F.size("x") == dim).mapInArrow(run, schema)


def whiten(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """Every usable row of ``vectors`` on each of its leading ``components``, scaled to variance one over the distinct vectors."""
    x = integers(vectors, vector_col, carry)
    model, dim = fit(x.select("x"), components)
    return transform(x, model, dim)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four leading components of all distinct ones."""
    rows = whiten(read(spark, sf_dir, "embeddings"), carry=("vec_id",))
    return rows.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
