"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The vectors, rounded down to steps of 1/1024 and shifted to positive whole numbers x, are written
once as blocks of rows.  With X the rows less their mean, the process builds orthonormal v (as long
as a vector) and u (as long as the table) with X V = U B, B bidiagonal.  Each step is one job: a
task forms its part of ``u = X y`` and, from it, of ``Xᵀ u``, and the parts are summed by Spark.
A u is never stored or gathered: every u is X w for a short w, so the tasks make its entries
when they need them.  Both sides are fully reorthogonalised.  For the u this needs
``uᵢ · p = wᵢ · (Xᵀ p)``, short vectors alone; where much cancels, the product is made anew from the
corrected vector.  Where the Krylov space is exhausted (a vanishing alpha or beta) the process
goes on from a new vector orthogonal to all v.  It ends when the leading triplets of B have
vanishing residuals and the variance outside the space is too small to hide another leading
component, or when the space is whole.  The SVD of B, with as many rows as steps, yields the components and
their deviations.

The driver holds some vectors as long as a row for each step (at most as many steps as
dimensions) and nothing that grows with the rows; tasks hold one block.  A pass reads the written blocks, so a lost
executor costs its tasks of one pass.

Defined cases: rows whose vector is null, holds a null or non-finite component, or is so long that
the squares of its steps pass 2^62 are dropped; a shorter vector is as if filled with zeros.
Repeated rows count as often as they occur; null ids stay null.  Components of vanishing variance
can't be whitened and are left out, so equal vectors, one row or an empty table give no rows.  A
deviation beyond 38 digits is null.  Further columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm import vectors
from dqflow.llm.frames import col
from dqflow.session import scratch_path

#: Added to the steps of a component.
SHIFT = 100000
#: Rows and bytes of a block.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
#: Relative size at which an alpha, a beta or a residual has vanished; share of the whole variance that counts as none.
VANISHED = 1e-13
NO_VARIANCE = 1e-13

BLOCK = "ids binary, size int, data binary"


def whiten(df: DataFrame, most: int = 8, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error)."""
    schema = "vec_id long, component int, n long, deviation string, whitened double, explained double"
    blocks, centre = _blocks(df, id_column, vector_column)
    components, variance, total = np.zeros((0, 0)), np.zeros(0), 0.0
    if centre.n:
        components, variance, total = principal(Products(blocks, centre), most)
    scale = components / np.sqrt(variance) if len(variance) else components

    def rows(batches):
        for ids, x in _read(batches):
            if not len(variance):
                continue
            size, m = len(x), len(variance)
            whitened = centre.centred(x) @ scale
            arrays = [
                pa.array(np.repeat(ids, m), mask=np.repeat(ids == -2**63, m)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), size)),
                pa.array(np.full(size * m, centre.n)), pa.array(np.repeat(centre.deviation(x), m), pa.string()),
                pa.array(whitened.ravel()), pa.array(np.tile(variance / total, size))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    done = blocks.mapInArrow(rows, schema)
    error = _identity_error(blocks, centre, scale) if len(variance) else None
    return done.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)")).withColumn("identity_error", F.lit(error).cast("double"))


class Centre:
    """Number of rows, and whole and remaining part of each dimension's mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n if n else 0 for s in sums], np.int64)
        self.rest = np.array([s % n if n else 0 for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``, rounded once."""
        return (x - self.whole) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[str]:
        """Exact sum of ``(n * x - S)^2`` over the dimensions, as digits."""
        off = x - self.whole
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if most * most * x.shape[1] >= 2**63:
            off = off.astype(object)
        each = off * self.n - self.rest
        return [str(v) for v in (each * each).sum(axis=1).tolist()]


def _blocks(df: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, Centre]:
    dims = vectors.dimensions(df, vector_column)
    given = df.select(col(id_column).cast("long").alias("id"), col(vector_column).cast("array<double>").alias("v")).where("v IS NOT NULL")
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dims)))

    def packed(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, most):
                some = batch.slice(first, most)
                taken, steps = vectors.steps(some.column("v"), dims)
                if len(taken):
                    x = steps + SHIFT
                    ids = np.asarray(some.column("id").fill_null(-2**63))[taken]
                    columns = {"ids": [ids.tobytes()], "size": pa.array([len(taken)], pa.int32()), "data": [x.tobytes()], "sums": [x.sum(axis=0).tolist()]}
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))

    spark = df.sparkSession
    path = scratch_path(spark, "vectors")
    schema = f"{BLOCK}, sums array<long>"
    given.mapInArrow(packed, schema).write.parquet(path)
    done = spark.read.schema(schema).parquet(path)
    row = done.agg(F.sum("size"), *[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(dims)]).first()
    return done.select("ids", "size", "data"), Centre(row[0] or 0, [int(s or 0) for s in row[1:]])


def _read(batches):
    """(ids, x) of each block."""
    for batch in batches:
        for ids, size, data in zip(*(batch.column(c) for c in ("ids", "size", "data")), strict=True):
            yield np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(data.as_buffer(), np.int64).reshape(size.as_py(), -1)


def _summed(blocks: DataFrame, length: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``make(x)`` over all blocks; one row leaves each task."""

    def run(batches):
        out = np.zeros(length)
        for _, x in _read(batches):
            out += make(x)
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()])], ["part"])

    parts = blocks.mapInArrow(run, "part array<double>")
    return np.array(parts.agg(*[F.sum(F.get("part", F.lit(i))) for i in range(length)]).first(), float)


class Products:
    """Distributed products with the centred rows."""

    def __init__(self, blocks: DataFrame, centre: Centre):
        self.blocks, self.centre, self.dims, self.n = blocks, centre, len(centre.whole), centre.n

    def __call__(self, y: np.ndarray) -> tuple[np.ndarray, float, float]:
        """For u = X y: ``Xᵀ u``, u's square and the sum of all squares of X."""
        centre = self.centre

        def make(x):
            rows = centre.centred(x)
            u = rows @ y
            return np.append(rows.T @ u, [u @ u, np.vdot(rows, rows)])

        out = _summed(self.blocks, self.dims + 2, make)
        return out[:-2], out[-2], out[-1]


def principal(product, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Components (as columns), their variances, falling, and the whole variance.

    ``product(y)`` gives ``Xᵀ X y``, ``|X y|²`` and the sum of squares of X; ``product.dims`` and
    ``product.n`` are X's columns and rows.
    """
    dims, n = product.dims, product.n
    random = np.random.default_rng(dims)
    v, w, xu = (np.zeros((dims, 0)) for _ in range(3))  # v; u = X w; Xᵀ u
    alphas, betas = [], []
    after, beta = _orthogonal(random.normal(size=dims), v), 0.0
    while True:
        v = np.column_stack([v, after / np.linalg.norm(after)])
        y = v[:, -1] - (beta * w[:, -1] if beta else 0.0)
        back, square, squares = product(y)
        if not squares:
            break
        size = math.sqrt(squares)
        own = w.T @ back
        y, back = y - w @ own, back - xu @ own
        if y @ back < 0.5 * square:
            back, square, _ = product(y)
            own = w.T @ back
            y, back = y - w @ own, back - xu @ own
        alpha = math.sqrt(max(0.0, y @ back))
        gone = alpha <= VANISHED * size
        alphas.append(0.0 if gone else alpha)
        w, xu = (np.column_stack([a, np.zeros(dims) if gone else b / alpha]) for a, b in ((w, y), (xu, back)))
        after = _orthogonal(xu[:, -1] - alphas[-1] * v[:, -1], v)
        beta = float(np.linalg.norm(after))
        left, sigma, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        outside = squares - float(sigma @ sigma)
        leading = sigma[:most]
        settled = np.all(beta * np.abs(left[-1, :most]) <= VANISHED * sigma[0])
        done = settled and (outside <= NO_VARIANCE * squares or len(leading) == most and outside < leading[-1] ** 2)
        if v.shape[1] == dims or done:
            found = leading ** 2 > NO_VARIANCE * squares
            return v @ right[:most].T[:, found], leading[found] ** 2 / n, squares / n
        if beta <= VANISHED * size:
            after, beta = _orthogonal(random.normal(size=dims), v), 0.0
        betas.append(beta)
    return np.zeros((dims, 0)), np.zeros(0), 0.0


def _orthogonal(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    for _ in range(2):
        a = a - v @ (v.T @ a)
    return a


def _identity_error(blocks: DataFrame, centre: Centre, scale: np.ndarray) -> float:
    m = scale.shape[1]

    def make(x):
        rows = centre.centred(x) @ scale
        return np.append(rows.T @ rows, rows.sum(axis=0))

    out = _summed(blocks, m * m + m, make)
    mean = out[m * m:] / centre.n
    return float(np.abs(out[:m * m].reshape(m, m) / centre.n - np.outer(mean, mean) - np.eye(m)).max())
