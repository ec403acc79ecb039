"""Whitening of embeddings: leading principal components by Chebyshev-filtered subspace iteration.

The fit list, each distinct vector once, is written as a table. A pass sends a block of vectors Q to the tasks, which centre their rows
X exactly and give their part of X'(XQ); parts are added up by row of the result, so the driver gets dimension x block
numbers however many rows there are. The recurrence of the Chebyshev polynomials over such passes damps the unwanted part of the spectrum;
QR and Rayleigh-Ritz on the block follow, until the residual of every wanted pair is at the level of rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.store import written

COMPONENTS = 16
#: Entries become whole numbers, floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors in the block beyond the wanted ones, and the degree of the filter.
EXTRA, DEGREE = 16, 10
#: A pair counts as certified at this residual, relative to the largest eigenvalue. Rounding leaves about 1e-15.
RESIDUAL = 2e-14
#: Eigenvalues below this share of the largest are no components: the data do not vary there.
RANK = 1e-10
#: Entries of this size and more cannot be summed exactly; a vector with one counts as not finite.
_LARGEST = float(1 << 46)
_LANCZOS, _ROUNDS, _ROWS = 8, 400, 4096


def whole(vector: Column) -> Column:
    """The vector's whole numbers; NULL for a NULL vector and for one with a NULL, non-finite or too large entry."""
    real = vector.cast("array<double>")
    usable = F.forall(real, lambda c: c.isNotNull() & (F.abs(c) < F.lit(_LARGEST)))  # NaN is the largest of all
    return F.when(usable, F.transform(real, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT).cast("long")))


def _matrices(batches: Iterator[pa.RecordBatch], column: int, dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


class Centre:
    """The mean S / n, split into whole numbers and a rest, so that n * x - S and x - S / n are exact until the last step."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - S) ** 2 for each row."""
        y = x - self.base
        if (int(np.abs(y).max(initial=0)) + 1) * self.n < int(np.sqrt((1 << 62) / max(1, x.shape[1]))):
            return ((y * self.n - self.rest) ** 2).sum(axis=1).tolist()
        return ((y.astype(object) * self.n - self.rest) ** 2).sum(axis=1).tolist()


def _sums(fit: DataFrame, dimension: int) -> list[int]:
    """Sum of each dimension over the fit list, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dimension
        for _, x in _matrices(batches, 0, dimension):
            total = [t + s for t, s in zip(total, x.sum(axis=0).tolist())]  # 4,096 numbers under 2 ** 53 fit
        yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), pa.array(map(str, total), pa.string())], ["i", "s"])

    parts = fit.mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return [int(r["s"]) for r in parts.orderBy("i").collect()]


def _added(fit: DataFrame, part, rows: int, columns: int, dimension: int) -> np.ndarray:
    """Sum over all rows of part(x), a matrix of rows x columns; one such matrix a task, added up row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, columns))
        for _, x in _matrices(batches, 0, dimension):
            total += part(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), *map(pa.array, total.T.copy())], ["i", *names])

    names = [f"c{k}" for k in range(columns)]
    parts = fit.mapInArrow(run, ", ".join(["i int", *[f"{c} double" for c in names]]))
    found = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).orderBy("i").collect()
    return np.array([r[1:] for r in found])


class Components:
    """Eigenvalues, falling, unit eigenvectors as columns, the trace of the covariance, and how it was found."""

    def __init__(self, values: np.ndarray, vectors: np.ndarray, trace: float, residual: float, passes: int):
        self.values, self.vectors, self.trace, self.residual, self.passes = values, vectors, trace, residual, passes


def chebyshev(apply, dimension: int, wanted: int, extra: int = EXTRA, degree: int = DEGREE, tolerance: float = RESIDUAL) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, residual) of the wanted largest eigenpairs of a symmetric positive semidefinite operator.

    apply gives the operator times a block. Once past the tolerance's thousandfold, a residual that no longer falls is taken to be
    at the level of rounding.
    """
    rng = np.random.default_rng(0)
    size = min(dimension, wanted + extra)
    block = np.linalg.qr(rng.standard_normal((dimension, size)))[0]
    low = 0.0
    if size < dimension:  # a bound from below by Lanczos, with the last residual taken off for safety
        q, before, beta = rng.standard_normal(dimension), np.zeros(dimension), 0.0
        q /= np.linalg.norm(q)
        main, off = [], []
        for _ in range(min(_LANCZOS, dimension)):
            r = apply(q[:, None])[:, 0] - beta * before
            main.append(float(q @ r))
            r -= main[-1] * q
            beta = float(np.linalg.norm(r))
            off.append(beta)
            if beta <= 1e-12 * abs(main[0]):
                break
            before, q = q, r / beta
        low = max(0.0, float(np.linalg.eigvalsh(np.diag(main) + np.diag(off[:-1], 1) + np.diag(off[:-1], -1))[0]) - off[-1])
    last = np.inf
    for _ in range(_ROUNDS):
        image = apply(block)
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residual = float(np.linalg.norm(image - block * values, axis=0)[:wanted].max() / max(values[0], np.finfo(float).tiny))
        if values[0] <= 0 or residual <= tolerance or (residual <= 1000 * tolerance and residual > last / 2):
            return values[:wanted], block[:, :wanted], residual
        last = residual
        if size == dimension:  # the block is the whole space: only rounding is left
            block = np.linalg.qr(block)[0]
            continue
        high = max(float(values[-1]), 1e-12 * float(values[0]))
        least = min(low, 0.9 * high)
        middle, half = (high + least) / 2, (high - least) / 2
        # Scaled by its value at the largest eigenvalue, the recurrence cannot overflow.
        sigma = first = half / (float(values[0]) - middle)
        older, newer = block, (image - middle * block) * (sigma / half)
        for _ in range(degree - 1):
            scale = 1 / (2 / first - sigma)
            older, newer = newer, (apply(newer) - middle * newer) * (2 * scale / half) - (sigma * scale) * older
            sigma = scale
        block = np.linalg.qr(newer)[0]
    raise RuntimeError(f"residual {residual:.1e} after {_ROUNDS} rounds")


def components(fit: DataFrame, centre: Centre, dimension: int, wanted: int = COMPONENTS) -> Components:
    """The leading components of a written table of distinct whole vectors x."""
    passes = 0

    def apply(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        sent = fit.sparkSession.sparkContext.broadcast(block)

        def part(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return c.T @ (c @ sent.value)

        try:
            return _added(fit, part, *block.shape, dimension) / centre.n
        finally:
            sent.destroy()

    values, vectors, residual = chebyshev(apply, dimension, min(wanted, dimension))
    trace = float(_added(fit, lambda x: (centre.centred(x) ** 2).sum(axis=0)[:, None], dimension, 1, dimension).sum()) / centre.n
    real = values > RANK * max(float(values[0]), 0.0)
    return Components(values[real], vectors[:, real], trace, residual, passes)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each usable row and component.

    A row is usable if its vector is not NULL, holds no NULL or non-finite entry (nor one of 2 ** 46 or more in size, which whole
    arithmetic can't hold), and has the length that most distinct vectors have, the longest of those in a tie. The fit list holds each
    distinct whole vector once, n in all. Components are numbered from 1 by falling eigenvalue; directions in which the data do not
    vary are none, so equal vectors, a single one or an empty table give no rows. deviation is NULL where it passes 64 bits.
    identity_error is measured on the whitened fit list in a pass of its own. Repeated rows and ids come out as often as
    they came in; other columns are not read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType
    rows = vectors.select(F.col(id_col).alias("vec_id"), whole(F.col(vector_col)).alias("x")).where("x IS NOT NULL")
    every = written(rows.select("x").distinct(), "vectors")
    shape = T.StructType(
        [T.StructField("vec_id", kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    length = every.where(F.size("x") > 0).groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not length:
        return spark.createDataFrame([], shape)
    dimension, n = length[0]["d"], length[0]["count"]
    fit = every.where(F.size("x") == dimension)
    centre = Centre(n, _sums(fit, dimension))
    found = components(fit, centre, dimension, wanted)
    k = len(found.values)
    if not k:
        return spark.createDataFrame([], shape)
    axes = found.vectors / np.sqrt(found.values)
    explained = found.values / found.trace

    def part(x: np.ndarray) -> np.ndarray:
        w = centre.centred(x) @ axes
        return w.T @ w

    error = float(np.abs(_added(fit, part, k, k, dimension) / n - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, 1, dimension):
            w = centre.centred(x) @ axes
            again = np.repeat(np.arange(len(x)), k)
            deviation = [d if d < 1 << 63 else None for d in centre.deviations(x)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(again)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(again), n)),
                    pa.array(deviation, pa.int64()).take(pa.array(again)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(again), error)),
                ],
                shape.fieldNames(),
            )

    return rows.where(F.size("x") == dimension).mapInArrow(run, shape)
