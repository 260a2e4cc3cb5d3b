"""Whitening of vectors by an exact, bit-sliced scatter matrix.

Entries become whole numbers ``x = floor(scale * entry) + shift``. A task takes its rows in blocks, subtracts
each dimension's minimum in the block, packs every bit plane of every dimension across the rows into 64-bit words, and
counts the bits that pairs of planes share: the counts, weighted by powers of two, add up to the exact cross-products.
Totals of all tasks are sums of whole numbers (decimals of 38 digits), so the order of tasks does not matter. The driver
gets one number per pair of dimensions, centres as whole numbers (n times the cross-product less the product of sums), divides once,
and hands the covariance to ``eigh``.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, as are rows
whose length is not the most frequent one (of equally frequent ones the larger); a null id stays null; repeated rows count as often as they are there; an
empty table gives no rows. A component without variance (no more than rounding) has null ``whitened`` values and no part in ``identity_error``;
``explained`` is null if no dimension varies. Entries whose ``x`` is beyond 2**40 stop the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches

#: Rows of a block, a multiple of 64.
BLOCK = 4_096
LIMIT = 1 << 40
SAFE = 1 << 62


def usable(rows: DataFrame, vector: str, row_id: str) -> DataFrame:
    """``vec_id, vector`` of the rows that count, without those of another length."""
    v = F.col("vector")
    sound = v.isNotNull() & (F.size(v) > 0) & ~F.exists(
        v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.select(F.col(row_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).filter(F.coalesce(sound, F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = lengths.agg(F.max_by("size", F.struct("n", "size"))).first()[0]
    return rows.filter(F.size("vector") == F.lit(common or 0))


def numbers(column: pa.Array, scale: int, shift: int) -> np.ndarray:
    """Rows of whole numbers."""
    if pa.types.is_large_list(column.type):
        flat = column.flatten()
    else:
        flat = column.cast(pa.large_list(pa.float64())).flatten()
    x = np.floor(scale * flat.to_numpy(zero_copy_only=False))
    if len(x) and np.abs(x).max() > LIMIT:
        raise ValueError(f"an entry times {scale} is beyond {LIMIT}")
    return x.astype(np.int64).reshape(len(column), -1) + shift


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of non-negative numbers, least first: dimension, bit, words of 64 rows."""
    rows, size = y.shape
    words = -(-rows // 64)
    padded = np.zeros((size, words * 64), np.int64)
    padded[:, :rows] = y.T
    out = np.empty((size, bits, words), np.uint64)
    for bit in range(bits):
        out[:, bit] = np.packbits((padded >> bit & 1).astype(np.uint8), axis=1).view(np.uint64)
    return out


def cross_products(y: np.ndarray) -> np.ndarray:
    """Sums over rows of products of every two columns of non-negative numbers, exactly, upper half."""
    rows, size = y.shape
    bits = max(1, int(y.max(initial=0)).bit_length())
    kind = np.int64 if 4 ** bits * rows < SAFE else object
    sliced = planes(y, bits)
    flat = sliced.reshape(size * bits, -1)
    weight = np.array([1 << b for b in range(bits)], kind)
    out = np.zeros((size, size), kind)
    for d in range(size):
        # Each plane of this dimension against all planes of it and of later ones.
        later = flat[d * bits:]
        shared = np.stack([np.bitwise_count(plane & later).sum(1, dtype=np.int64) for plane in sliced[d]])
        out[d, d:] = (weight[:, None, None] * shared.reshape(bits, size - d, bits).astype(kind) * weight).sum((0, 2))
    return out


def scatter(x: np.ndarray) -> np.ndarray:
    """Sums and cross-products as Python numbers, upper half: row 0 has the number of rows and the sums."""
    rows, size = x.shape
    least = x.min(0)
    y = x - least
    out = np.zeros((size + 1, size + 1), object)
    least, sums = least.astype(object), y.sum(0).astype(object)
    out[0, 0] = rows
    out[0, 1:] = sums + rows * least
    cross = cross_products(y).astype(object)
    out[1:, 1:] = np.triu(cross + np.outer(least, sums) + np.outer(sums, least) + rows * np.outer(least, least))
    return out


def _totals(rows: DataFrame, measure, width: str = "decimal(38,0)") -> dict[tuple[int, int], Decimal | float]:
    """Sum matrices of all tasks: one number per cell reaches the driver."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            part = measure(block)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            kind = pa.decimal128(38, 0) if width.startswith("decimal") else pa.float64()
            values = [Decimal(int(v)) for v in total[i, j]] if width.startswith("decimal") else total[i, j].astype(float)
            yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(values, kind)})

    found = rows.select("vector").mapInArrow(cells, f"i int, j int, v {width}").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r["i"], r["j"]): r["v"] for r in found.collect()}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    """Vectors in blocks of ``BLOCK`` rows."""
    held, n = [], 0
    for batch in batches:
        column = batch.column("vector")
        for at in range(0, len(column), BLOCK):
            held.append(column.slice(at, BLOCK))
            n += len(held[-1])
            if n >= BLOCK:
                yield pa.concat_arrays(held)
                held, n = [], 0
    if n:
        yield pa.concat_arrays(held)


@dataclass
class Whitening:
    """A fit: number of rows, sums, covariance, and its components in rows, strongest first."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray
    scale: int
    shift: int
    identity_error: float | None = None

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    def varies(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        return self.values > len(self.sums) * np.finfo(float).eps * max(self.trace, 0)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        sums = np.array(self.sums, object)
        if self.n * (LIMIT + abs(self.shift)) < SAFE:
            return x * self.n - sums.astype(np.int64)
        return x.astype(object) * self.n - sums

    def project(self, deviations: np.ndarray) -> np.ndarray:
        """Rows projected on the components, over the square roots of their values."""
        used = self.varies()
        axes = np.zeros_like(self.components)
        axes[used] = self.components[used] / np.sqrt(self.values[used])[:, None]
        return deviations.astype(float) / self.n @ axes.T


def fit(rows: DataFrame, most: int, scale: int, shift: int) -> Whitening | None:
    """Fit on ``vector`` of all rows; None without rows."""
    total = _totals(rows, lambda block: scatter(numbers(block, scale, shift)))
    if not total:
        return None
    size = max(j for _, j in total)
    n, sums = int(total[0, 0]), [int(total[0, j]) for j in range(1, size + 1)]
    v = np.empty((size, size))
    with localcontext() as exact:
        exact.prec = 120
        for i in range(size):
            for j in range(i, size):
                v[i, j] = v[j, i] = float(Decimal(n * int(total[i + 1, j + 1]) - sums[i] * sums[j]) / (n * n))
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(values)[::-1][:most]
    return Whitening(n, sums, v, values[order], vectors.T[order], scale, shift)


def measured(rows: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    used = model.varies()
    if not used.any():
        return None

    def products(block: pa.Array) -> np.ndarray:
        w = model.project(model.deviations(numbers(block, model.scale, model.shift)))[:, used]
        return w.T @ w

    total = _totals(rows, products, "double")
    return max(abs(v / model.n - (i == j)) for (i, j), v in total.items())


def whitened(
    rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id", most: int = 8, scale: int = 1024, shift: int = 100_000,
) -> tuple[DataFrame, Whitening | None]:
    """``vec_id, deviation, whitened`` (one value per component) of every usable row, and the fit."""
    bounded_batches(rows.sparkSession)
    rows = usable(rows, vector, row_id)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"
    model = fit(rows, most, scale, shift)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema), None
    model.identity_error = measured(rows, model)
    used = model.varies()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                apart = model.deviations(numbers(part.column("vector"), scale, shift))
                w = model.project(apart)
                if apart.dtype != object and apart.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 >= SAFE:
                    apart = apart.astype(object)
                squares = (apart * apart).sum(1)
                values = pa.array(w.ravel(), mask=np.tile(~used, len(w)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * len(used)), values)
                yield pa.record_batch({
                    "vec_id": part.column("vec_id"),
                    "deviation": pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0)), "whitened": lists})

    return rows.mapInArrow(apply, schema), model
