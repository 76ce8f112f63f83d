"""Whitening of embeddings, with the scatter matrix counted from bit planes.

Entries become whole numbers. Of each dimension the numbers, less their
minimum, are written as bit planes: one bit per row, 64 rows to a word. The
product of two dimensions summed over all rows is then the number of rows in
which a bit of one and a bit of the other are both set, times the weights of
the bits: AND, count, add. Everything up to the covariance is exact; only then
does it become floating-point numbers.

Spark adds up the sums of all tasks, one row for each pair of dimensions.
What the driver gets is as large as the square of the dimensions, whatever the
number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from querylens.sources.scratch import materialize

SCALE = 256
COMPONENTS = 4

_LIMB = 32  # bits of the lower part of a sum, so that a long holds it for 2^31 tasks; the rest goes into a decimal
_PLANES_AT_ONCE = 32
_ROWS_AT_ONCE = 1 << 14  # rows whose bit planes are held at a time


@dataclass(frozen=True)
class Whitening:
    """Of the fit list: its rows, sums, and for each component its axis over the root of its eigenvalue."""

    n: int
    sums: list[int]
    axes: np.ndarray  # (dimensions, components); NaN for a component without variance
    explained: list[float]


def quantized(vector: Column) -> Column:
    """Each entry times ``SCALE``, rounded down, as a long; beyond a long, the nearest one."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return vector.isNotNull() & finite & (F.size(vector) > 0)


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as the rows of an array of longs."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _planes(shifted: np.ndarray, bits: int) -> np.ndarray:
    """(dimensions * bits, words): the bits of each dimension, the lowest first, 64 rows to a word."""
    rows, dims = shifted.shape
    words = -(-rows // 64)
    planes = np.zeros((dims, bits, words * 8), np.uint8)
    for bit in range(bits):
        row = np.packbits((shifted >> np.uint64(bit) & np.uint64(1)).astype(bool), axis=0, bitorder="little")
        planes[:, bit, : row.shape[0]] = row.T
    return planes.reshape(dims * bits, -1).view(np.uint64)


def _and_counts(planes: np.ndarray) -> np.ndarray:
    """Rows in which both of two planes are set, for each pair of planes with the first not after the second."""
    found = np.zeros((len(planes), len(planes)), np.int64)
    for start in range(0, len(planes), _PLANES_AT_ONCE):
        for one in range(start, min(start + _PLANES_AT_ONCE, len(planes))):
            found[one, one:] = np.bitwise_count(planes[one] & planes[one:]).sum(axis=1, dtype=np.int64)
    return found


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums of each dimension of ``x`` and of the products of each two, as exact whole numbers."""
    rows, dims = x.shape
    least = x.min(axis=0)
    shifted = x.view(np.uint64) - least.view(np.uint64)  # never below zero, and below 2^64
    bits = max(1, int(shifted.max()).bit_length())
    counts = _and_counts(_planes(shifted, bits))
    counts = np.triu(counts) + np.triu(counts, 1).T
    counts = counts.reshape(dims, bits, dims, bits)
    exact = object if 2 * bits + rows.bit_length() > 62 else np.int64
    weights = np.array([1 << b for b in range(bits)], exact)
    products = np.zeros((dims, dims), exact)
    for a in range(bits):
        for b in range(bits):
            products += counts[:, a, :, b].astype(exact) * (weights[a] * weights[b])
    single = counts[np.arange(dims), :, np.arange(dims), :].diagonal(axis1=1, axis2=2)  # rows with the bit, by dimension and bit
    totals = [sum(int(c) << b for b, c in enumerate(row)) for row in single]
    low = [int(v) for v in least]
    sums = [t + rows * m for t, m in zip(totals, low)]
    cross = [
        [int(products[i, j]) + low[i] * totals[j] + low[j] * totals[i] + rows * low[i] * low[j] for j in range(dims)]
        for i in range(dims)
    ]
    return sums, cross


_SUMS = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("high", T.DecimalType(38, 0)),
        T.StructField("low", T.LongType()),
    ]
)


def _sum_rows(n: int, sums: list[int], cross: list[list[int]]) -> pa.RecordBatch:
    """One row for each sum: number of rows at (-1, -1), of a dimension at (i, -1), of a pair at (i, j)."""
    dims = range(len(sums))
    cells = [(-1, -1, n), *((i, -1, sums[i]) for i in dims), *((i, j, cross[i][j]) for i in dims for j in dims if i <= j)]
    i, j, values = zip(*cells)
    arrays = [
        pa.array(i, pa.int32()),
        pa.array(j, pa.int32()),
        pa.array([Decimal(v >> _LIMB) for v in values], pa.decimal128(38, 0)),
        pa.array([v & ((1 << _LIMB) - 1) for v in values], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=_SUMS.names)


def _moments(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and sums of products of a table of vectors ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, None, None
        for batch in batches:
            for start in range(0, len(batch), _ROWS_AT_ONCE):
                x = _matrix(batch.column(0).slice(start, _ROWS_AT_ONCE))
                more_sums, more_cross = (np.array(part, object) for part in scatter(x))
                n += len(x)
                sums = more_sums if sums is None else sums + more_sums
                cross = more_cross if cross is None else cross + more_cross
        if n:
            yield _sum_rows(n, sums.tolist(), cross.tolist())

    rows = fit.select("x").mapInArrow(run, _SUMS).groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    cells = {(r["i"], r["j"]): (int(r["high"]) << _LIMB) + int(r["low"]) for r in rows.collect()}  # dimensions squared
    if not cells:
        return 0, [], []
    dims = range(sum(j == -1 for _, j in cells) - 1)
    return cells[-1, -1], [cells[i, -1] for i in dims], [[cells[min(i, j), max(i, j)] for j in dims] for i in dims]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of a table of distinct vectors ``x`` of one length."""
    n, sums, cross = _moments(fit)
    if not n:
        return Whitening(0, [], np.empty((0, 0)), [])
    dims = len(sums)
    centred = [[n * cross[i][j] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    # A quotient of whole numbers is the nearest double.
    covariance = np.array([[value / (n * n) for value in row] for row in centred])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = sum(centred[i][i] for i in range(dims))
    least = max(covariance.diagonal().sum(), 0.0) * dims * np.finfo(float).eps
    some = values > least
    axes = np.where(some, vectors / np.sqrt(np.where(some, values, 1.0)), np.nan)
    total = trace / (n * n)
    return Whitening(n, sums, axes, [float(v) / total if ok else 0.0 for v, ok in zip(values, some)])


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Centred vectors on the components; the mean's whole part is taken off exactly."""
    whole = [s // model.n for s in model.sums]
    rest = np.array([float(Fraction(s - w * model.n, model.n)) for s, w in zip(model.sums, whole)])
    away = (x - np.array(whole, np.int64)).astype(np.float64) - rest
    return away @ model.axes


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """The sum over dimensions of (n x - S)^2 of each vector, exactly: n^2 x.x - 2 n x.S + S.S."""
    most = max(abs(int(x.max())), abs(int(x.min())), 1)
    bound = most * max(most, *(abs(s) for s in model.sums), 1) * x.shape[1]
    exact = x if bound < 1 << 62 else x.astype(object)
    squares = (exact * exact).sum(axis=1).tolist()
    products = (exact * np.array(model.sums, exact.dtype)).sum(axis=1).tolist()
    n, rest = model.n, sum(s * s for s in model.sums)
    return [n * n * a - 2 * n * b + rest for a, b in zip(squares, products)]


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance minus the identity; NULL without components."""
    some = [i for i in range(model.axes.shape[1]) if not np.isnan(model.axes[0, i])]
    if not some:
        return None
    schema = "i int, j int, total double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                z = _projected(_matrix(batch.column(0)), model)[:, some]
                z = np.hstack([z, np.ones((len(z), 1))])
                i, j = np.triu_indices(z.shape[1])
                arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array((z.T @ z)[i, j])]
                yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "total"])

    found = {}
    for row in fit.select("x").mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        found[row["i"], row["j"]] = row["total"] / model.n
    k = len(some)
    entries = [found[i, j] - found[i, k] * found[j, k] - (i == j) for i in range(k) for j in range(i, k)]
    return max(abs(e) for e in entries)


def whiten(
    embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact), a row per vector and component.

    Vectors that are NULL, without entries, or hold NULL or infinite entries
    or NaN are left out. So are vectors of another length than most have (the
    longer of two equally frequent ones): they are no points of the same space.
    Equal vectors count once in the fit and have a row each in the result, as
    have rows with the same or a NULL id. With fewer dimensions than
    ``components`` there is a component for each. A component without variance
    has NULL as its whitened value and explains 0. ``deviation`` is NULL where
    it doesn't fit a long, which ``deviation_exact``, a decimal, mostly does.
    An empty table, or one without usable vectors, gives an empty one.
    """
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).where(_usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.agg(F.max_by("length", F.struct("n", "length")).alias("length")).first()["length"]
    rows = rows.where(F.size("v") == F.lit(common or 0)).select("vec_id", quantized(F.col("v")).alias("x"))
    fit = materialize(rows.select("x").distinct(), "fit-list")
    model = fit_whitening(fit, components)
    error = identity_error(fit, model) if model.n else None
    kept = [f for f in rows.schema.fields if f.name == "vec_id"]
    schema = T.StructType(
        [
            *kept,
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
            T.StructField("deviation_exact", T.DecimalType(38, 0)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1))
            z = _projected(x, model)
            count, each = z.shape
            far = _deviations(x, model)
            fits = [d if d < 1 << 63 else None for d in far]
            exact = [Decimal(d) if d < 10**38 else None for d in far]
            again = np.repeat(np.arange(count), each)
            whitened = z.reshape(-1)
            arrays = [
                batch.column(0).take(pa.array(again)),
                pa.array(np.tile(np.arange(1, each + 1, dtype=np.int32), count)),
                pa.array(np.full(len(again), model.n, np.int64)),
                pa.array(fits, pa.int64()).take(pa.array(again)),
                pa.array(whitened, mask=np.isnan(whitened)),
                pa.array(np.tile(np.array(model.explained, np.float64), count)),
                pa.array([error] * len(again), pa.float64()),
                pa.array(exact, pa.decimal128(38, 0)).take(pa.array(again)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)
