"""Whitening of vectors with the exact eigenvalues of their integer scatter matrix.

A vector's entries become integers; the distinct integer vectors are the fit list. Sums and
products over it are added up exactly, so the scatter matrix does not depend on partitioning
or order. ``spectrum`` takes its characteristic polynomial apart on the driver, whose work is
bounded by the number of dimensions. Then every row is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.frames import find_package, stored
from hearthwatt.llm.spectrum import components_of

#: Steps of an entry to a unit, and what is added so that usual entries are positive.
STEPS, OFFSET = 64, 1_000_000
#: Entries beyond this many steps are held there, so that all stay within 64 bits.
LARGEST = 2.0**61
#: Vectors multiplied at once: products of entries below 2 ** 20 then add up exactly in doubles.
VECTORS_AT_ONCE = 4096
#: Exact sums leave a task as three numbers of 40 bits and the rest.
LIMB = 40


def integer_vectors(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """``df`` with the column ``x``, without rows whose vector is null, is empty, holds null or
    non-finite entries, or has another length than most (of two as frequent, the longer)."""
    values = F.col(vector_col)
    finite = F.forall(values, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    usable = df.where((F.size(values) > 0) & finite)
    lengths = usable.groupBy(F.size(values).alias("length")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    usable = usable.where(F.size(values) == (usual["length"] if usual else 0))

    def steps(c: Column) -> Column:
        scaled = F.floor(F.greatest(F.least(c.cast("double") * STEPS, F.lit(LARGEST)), F.lit(-LARGEST)))
        return scaled.cast("long") + OFFSET

    return usable.withColumn("x", F.transform(values, steps))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as int64, without the offset, which no covariance depends on."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1).astype(np.int64) - OFFSET


def _products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x``, exact, as Python integers."""
    if not len(x) or np.abs(x).max() < 1 << 20:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    return x.astype(object).T @ x.astype(object)


def scatter(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """The number of vectors ``n``, their sums, and ``n`` times the sum of products less the
    product of sums, all exact; that matrix is ``n * n`` times the covariance."""
    schema = "i int, j int, high long, middle long, low long"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, VECTORS_AT_ONCE):
                x = _matrix(batch.column(0).slice(start, VECTORS_AT_ONCE))
                # A leading one adds the sums and the number of vectors to the products.
                part = _products(np.hstack([np.ones((len(x), 1), np.int64), x]))
                total = part if total is None else total + part
        if total is not None:
            cells = [(i, j, int(total[i, j])) for i in range(len(total)) for j in range(i, len(total))]
            i, j, value = zip(*cells, strict=True)
            mask = (1 << LIMB) - 1
            limbs = [[v >> 2 * LIMB for v in value], [v >> LIMB & mask for v in value], [v & mask for v in value]]
            yield pa.RecordBatch.from_pydict(dict(zip(target.names, [i, j, *limbs], strict=True)), schema=target)

    parts = fit.select("x").mapInArrow(run, schema)
    sums = parts.groupBy("i", "j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "middle", "low")])
    found = {}
    for r in sums.collect():
        found[r["i"], r["j"]] = (int(r["high"]) << 2 * LIMB) + (int(r["middle"]) << LIMB) + int(r["low"])
    size = max((i for i, _ in found), default=0)
    total = [found[0, k + 1] for k in range(size)]
    n = found.get((0, 0), 0)
    cell = lambda i, j: n * found[min(i, j) + 1, max(i, j) + 1] - total[i] * total[j]
    return n, total, [[cell(i, j) for j in range(size)] for i in range(size)]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` as exact integers: of 64 bits where these surely suffice."""
    largest = int(np.abs(x).max()) * n + max(map(abs, sums)) if len(x) else 0
    kind = np.int64 if largest < 1 << 62 else object
    return x.astype(kind) * n - np.array(sums, kind)


def _squares(away: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row, or none where it exceeds 64 bits."""
    if away.dtype == object:
        sums = [int(v) for v in (away * away).sum(axis=1)]
    else:
        # Halves of 16 bits: a larger entry's square alone exceeds 64 bits.
        beyond = (np.abs(away) >= 1 << 32).any(axis=1)
        high, low = np.where(beyond[:, None], 0, away) >> 16, away & 0xFFFF
        parts = [(a * b).sum(axis=1).tolist() for a, b in ((high, high), (high, low), (low, low))]
        sums = [1 << 64 if far else (a << 32) + (b << 17) + c for far, a, b, c in zip(beyond, *parts, strict=True)]
    return [v if v < 1 << 63 else None for v in sums]


def whiten(df: DataFrame, top: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each usable row and each of the first ``top`` components: ``n``, the row's squared
    ``deviation``, its ``whitened`` value, the share ``explained`` of the variance, and
    ``identity_error``, the largest difference between the covariance of the whitened fit list,
    computed from its values, and the identity.

    Entries become ``floor(64 * c) + 1000000``, those beyond 2 ** 61 steps the bound. Components without variance
    have no whitened value and no rows, so a table whose usable vectors are all alike, or none,
    gives no rows. Equal eigenvalues get some orthogonal vectors. Repeated rows and rows without
    id stay; the fit counts each integer vector once, however many rows have it. A ``deviation``
    beyond 64 bits is null. Columns other than the two named are not looked at.
    """
    spark = df.sparkSession
    find_package(spark)
    rows = integer_vectors(df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vector").select("id", "x")
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    n, sums, matrix = scatter(fit)
    found = components_of(matrix, top)
    trace = sum(matrix[k][k] for k in range(len(matrix)))
    # A deviation times this is a whitened value: the root of n * n times the eigenvalue divides.
    weights = np.array([vector / sqrt(value) for value, vector in found]).reshape(len(found), len(sums)).T
    explained = [value / trace for value, _ in found]
    count = len(found)
    error = _identity_error(fit, n, sums, weights) if count else 0.0

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if count else 0, VECTORS_AT_ONCE):
                part = batch.slice(start, VECTORS_AT_ONCE)
                away = _deviations(_matrix(part.column(1)), n, sums)
                squares = _squares(away)
                values = away.astype(np.float64) @ weights
                each = np.repeat(np.arange(len(part)), count)
                columns = [
                    part.column(0).take(pa.array(each)),
                    np.tile(np.arange(1, count + 1, dtype=np.int32), len(part)),
                    np.full(len(each), n, np.int64),
                    pa.array(squares, pa.int64()).take(pa.array(each)),
                    values.ravel(),
                    np.tile(explained, len(part)),
                    np.full(len(each), error),
                ]
                arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return rows.mapInArrow(run, schema)


def _identity_error(fit: DataFrame, n: int, sums: list[int], weights: np.ndarray) -> float:
    """From a second pass over the fit list: products of whitened values, which are centred."""
    schema = "i int, j int, value double"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((weights.shape[1],) * 2)
        for batch in batches:
            for start in range(0, batch.num_rows, VECTORS_AT_ONCE):
                x = _matrix(batch.column(0).slice(start, VECTORS_AT_ONCE))
                values = _deviations(x, n, sums).astype(np.float64) @ weights
                total += values.T @ values
        i, j = np.indices(total.shape)
        columns = [i.ravel().astype(np.int32), j.ravel().astype(np.int32), total.ravel()]
        yield pa.RecordBatch.from_pydict(dict(zip(target.names, columns, strict=True)), schema=target)

    cells = fit.select("x").mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("value").alias("value"))
    return max(abs(r["value"] / n - (r["i"] == r["j"])) for r in cells.collect())
