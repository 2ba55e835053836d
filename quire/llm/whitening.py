"""Embedding whitening from a bit-sliced scatter matrix.

An entry c counts as the integer x = floor(256 * c). Every distinct vector of integers is fitted
once. Its scatter matrix is exact: a block of rows is shifted by each dimension's least value, the
bits of one place value become a plane of one bit a row, packed into 64-bit words, and the product
sum of two dimensions is the sum over their planes of 2^(a + b) times the ones in plane a AND plane
b. The shift is taken out again in integers, blocks add up in Spark as decimals, and n * XX - S S'
is centred in integers before it is divided and given to ``eigh``. Nothing but matrices as wide as
a vector reaches the driver.

Edge cases: a row whose vector is null, empty, or holds a null, NaN or infinite entry is dropped,
and so is one whose length is not the commonest (of equally common lengths the longest); 256 * c
beyond 64 bits counts as the largest number of 64 bits; a null id is kept; repeated rows and
vectors are all returned, and fitted once; a component without variance (all vectors are equal, or
there are fewer than dimensions) has null ``whitened``; ``explained`` is null if no dimension
varies, ``identity_error`` if no component does; a deviation beyond 64 bits is null; vectors of
fewer than four dimensions have as many components; an empty table has no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import discard, slices, written
from quire.session import read_table

#: An entry is counted in units of one part in so many.
SCALE = 256
COMPONENTS = 4
#: Rows of a block whose planes are counted at once.
BLOCK_ROWS = 1 << 14
#: Sums travel as high * 2^60 + low.
_LOW = 60


def integers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` with ``x``, the integers of the vector, where all of its entries are finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))
    return (rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(finite)
            .withColumn("x", F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of unsigned columns, packed across rows into words; each one's column and bit."""
    bits = np.array([int(m).bit_length() for m in u.max(0)])
    words = -(-len(u) // 64)
    packed, column, bit = [], [], []
    for b in range(int(bits.max(initial=0))):
        cols = np.flatnonzero(bits > b)
        plane = np.zeros((len(cols), words * 8), dtype=np.uint8)
        ones = ((u[:, cols] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        plane[:, :-(-len(u) // 8)] = np.packbits(ones, axis=0).T
        packed.append(plane.view(np.uint64))
        column.append(cols)
        bit.append(np.full(len(cols), b))
    if not packed:
        return np.zeros((0, words), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    column, bit = np.concatenate(column), np.concatenate(bit)
    order = np.lexsort((bit, column))
    return np.concatenate(packed)[order], column[order], bit[order]


def scatter_block(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and product sums of the columns of a block, as Python integers."""
    rows, width = x.shape
    low = x.min(0)
    words, column, bit = planes(x.astype(np.uint64) - low.astype(np.uint64))
    # integers of the machine while no sum can pass 63 bits
    small = 2 * (int(bit.max(initial=0)) + 1) + rows.bit_length() < 62
    kind = np.int64 if small else object
    value = np.array([1 << int(b) for b in bit], dtype=kind)
    sums, products = np.zeros(width, dtype=kind), np.zeros((width, width), dtype=kind)
    np.add.at(sums, column, np.bitwise_count(words).sum(1, dtype=np.int64).astype(kind) * value)
    for p in range(len(words)):
        count = np.bitwise_count(words[p] & words[p:]).sum(1, dtype=np.int64).astype(kind)
        count *= value[p] * value[p:]
        count[1:][column[p + 1:] == column[p]] *= 2  # either plane may come first
        np.add.at(products[column[p]], column[p:], count)
    sums, products, low = sums.astype(object), products.astype(object), low.astype(object)
    products = np.triu(products) + np.triu(products, 1).T
    products = products + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)
    return sums + rows * low, products


def _scatter(width: int) -> Callable:
    """From vectors: (i, j, high, low) of the sum of x_i * x_j over a task's rows; j = -1: of x_i,
    i = -1: of 1."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        held, n = [], 0
        for batch in slices(batches, BLOCK_ROWS):
            held.append(matrix(batch.column(0), width))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield np.concatenate(held)
                held, n = [], 0
        if n:
            yield np.concatenate(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, 0, 0
        for x in blocks(batches):
            s, p = scatter_block(x)
            n, sums, products = n + len(x), sums + s, products + p
        if not n:
            return
        i, j = np.triu_indices(width)
        cells = [(-1, -1, n), *((a, -1, s) for a, s in enumerate(sums)),
                 *zip(i.tolist(), j.tolist(), products[i, j], strict=True)]
        for at in range(0, len(cells), 1 << 14):
            a, b, v = zip(*cells[at:at + (1 << 14)], strict=True)
            high, low = zip(*(divmod(int(x), 1 << _LOW) for x in v), strict=True)
            number = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                 pa.array([Decimal(x) for x in high], number), pa.array([Decimal(x) for x in low], number)],
                ["i", "j", "high", "low"])

    return run


@dataclass
class Whitening:
    """``axes``: a column for each component; ``values``: their variances, falling; ``total``: of all."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    total: float

    @property
    def varies(self) -> np.ndarray:
        """Components that have a variance beyond the rounding of the largest one."""
        return self.values > len(self.sums) * np.finfo(float).eps * max(self.values[0], 0.0)


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """From distinct vectors ``x`` of one length; the driver gets one number for each pair of dimensions."""
    cells = (distinct.select("x").mapInArrow(_scatter(width), "i int, j int, high decimal(38,0), low decimal(38,0)")
             .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    value = {(r.i, r.j): (int(r.high) << _LOW) + int(r.low) for r in cells}
    n, sums = value[-1, -1], [value[i, -1] for i in range(width)]
    v = np.empty((width, width))
    for i in range(width):
        for j in range(i, width):
            v[i, j] = v[j, i] = (n * value[i, j] - sums[i] * sums[j]) / (n * n)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    # one sign for all runs: the entry farthest from 0 is positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    return Whitening(n, sums, axes, values, float(np.trace(v)))


def _projected(model: Whitening, names: list[str]) -> Callable:
    """From rows whose last column is x: the other columns, ``deviation`` and ``whitened``."""
    n, sums, axes, varies = model.n, model.sums, model.axes, model.varies
    scale = np.sqrt(np.where(varies, model.values, 1.0))
    width = len(sums)
    most = max(abs(s) for s in sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            x = matrix(batch.column(batch.num_columns - 1), width)
            large = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
            if (n * large + most) ** 2 * width < 1 << 63:
                d = n * x - np.array(sums, dtype=np.int64)
                deviation = pa.array((d * d).sum(1), pa.int64())
                centred = d / n
            else:
                d = n * x.astype(object) - np.array(sums, dtype=object)
                deviation = pa.array([s if s < 1 << 63 else None for s in (d * d).sum(1)], pa.int64())
                centred = np.array([[a / n for a in row] for row in d], dtype=float).reshape(-1, width)
            white = centred @ axes / scale
            flat = pa.array(white.ravel(), mask=np.tile(~varies, len(x)))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(varies))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], deviation, pa.ListArray.from_arrays(offsets, flat)], names)

    return run


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows``, whose last column is x, with ``deviation`` and ``whitened`` in its place."""
    kept = rows.schema.fields[:-1]
    names = [*(f.name for f in kept), "deviation", "whitened"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return rows.mapInArrow(_projected(model, names), ", ".join([*fields, "deviation long", "whitened array<double>"]))


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest entry, by size, of the whitened fit list's covariance minus the identity; centred
    by ``covar_pop``'s merging of central moments."""
    which = np.flatnonzero(model.varies).tolist()
    if not which:
        return None
    white = project(distinct.select("x"), model)
    pairs = [(a, b) for a in which for b in which if a <= b]
    row = white.agg(*(F.covar_pop(F.get("whitened", F.lit(a)), F.get("whitened", F.lit(b))) for a, b in pairs)).first()
    return max(abs(c - (a == b)) for c, (a, b) in zip(row, pairs, strict=True))


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of rows (vec_id, embedding)."""
    x = integers(rows.select("vec_id", "embedding")).select("vec_id", "x")
    schema = ("vec_id {}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double").format(x.schema["vec_id"].dataType.simpleString())
    sizes = x.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return rows.sparkSession.createDataFrame([], schema)
    x = x.filter(F.size("x") == common.size)
    distinct = written(x.select("x").distinct(), "whitening-fit")
    model = fit(distinct, common.size, components)
    error = identity_error(distinct, model)
    discard(distinct)
    share = F.array(*(F.lit(float(e) / model.total if model.total > 0 else None).cast("double") for e in model.values))
    # an outer explode: a plain one would have the optimizer project every row twice
    return project(x, model).select("vec_id", "deviation", F.posexplode_outer("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
