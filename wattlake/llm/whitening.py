"""Whitening of fixed-point vectors by a QR of their centred rows and a qd solver.

The rows are centred and reduced block by block to a triangular matrix R with R^T R = n times
their covariance (a QR of each block stacked on the R so far, then QRs of stacked R's), so the
covariance itself, which would square the condition, is never formed.  The singular values of R,
which is as small as a vector is wide, give the eigenvalues, and its right singular vectors the
directions (:mod:`wattlake.llm.bidiagonal`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from wattlake.llm.bidiagonal import right_singular
from wattlake.llm.partials import fold
from wattlake.llm.vectors import matrix, widest

#: Rows reduced together.
BLOCK = 4096


@dataclass(frozen=True)
class Whitening:
    """What a table's vectors have in common: their number, exact sums per dimension, the
    eigenvalues of their covariance, falling, its trace, and the directions as columns."""

    count: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    trace: float
    directions: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.count, self.sums) @ (self.directions / np.sqrt(self.eigenvalues))


def centred(x: np.ndarray, count: int, sums: tuple[int, ...]) -> np.ndarray:
    """Integer rows less their mean: the whole part of it exactly, then the rest."""
    whole = [s // count for s in sums]
    rest = np.array([(s - count * w) / count for s, w in zip(sums, whole, strict=True)])
    return (x - np.array(whole, np.int64)).astype(np.float64) - rest


def _complete(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there with all its components."""
    known = F.col(vector_col).isNotNull() & F.forall(vector_col, lambda x: x.isNotNull())
    return vectors.filter(known)


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, (0, width - len(x))) if len(x) < width else x


def _sums(vector_col: str):
    def add(state, batch: pa.RecordBatch):
        column = batch.column(vector_col)
        x = matrix(column, widest(column), np.int64)
        if np.abs(x.astype(np.float64)).sum() >= 2.0**62:
            x = x.astype(object)
        here = (len(x), np.array([int(s) for s in x.sum(0)], object))
        return here if state is None else merge(state, here)

    def merge(a, b):
        width = max(len(a[1]), len(b[1]))
        return a[0] + b[0], _wide(a[1], width) + _wide(b[1], width)

    return add, merge


def _triangles(vector_col: str, count: int, sums: tuple[int, ...]):
    def add(state, batch: pa.RecordBatch):
        x = matrix(batch.column(vector_col), len(sums), np.int64)
        for at in range(0, len(x), BLOCK):
            block = centred(x[at : at + BLOCK], count, sums)
            state = np.linalg.qr(block if state is None else np.vstack([state, block]), mode="r")
        return state

    return add, lambda a, b: np.linalg.qr(np.vstack([a, b]), mode="r")


def fit_whitening(vectors: DataFrame, vector_col: str = "vector", components: int | None = None) -> Whitening | None:
    """The whitening of a table of integer vectors, in two passes; None without any dimension.

    Vectors that are null or hold null take no part.  A shorter vector is taken as if it ended in zeros.  At most
    ``components`` directions, and none without variance: a constant table has none.
    """
    rows = _complete(vectors, vector_col).select(F.col(vector_col).cast("array<bigint>").alias(vector_col))
    found = fold(rows, *_sums(vector_col))
    if found is None or not len(found[1]):
        return None
    count, sums = found[0], tuple(found[1])
    r = fold(rows, *_triangles(vector_col, count, sums))
    values, directions = right_singular(r, components)
    trace = float((r.astype(np.longdouble) ** 2).sum() / count)
    return Whitening(count, sums, values**2 / count, trace, directions)


def whiten(vectors: DataFrame, model: Whitening, vector_col: str = "vector", name: str = "whitened") -> DataFrame:
    """The table with the whitened vector, one number per component; null for a null vector.

    A column of that name is replaced.  Vectors hold no null and are not wider than the model's.
    """
    kept = [f for f in vectors.schema.fields if f.name not in (name, vector_col)]
    vector = StructField(vector_col, ArrayType(vectors.schema[vector_col].dataType.elementType))
    schema = StructType([*kept, vector, StructField(name, ArrayType(DoubleType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                column = part.column(vector_col)
                known = column.is_valid().to_numpy(zero_copy_only=False)
                w = model.whitened(matrix(column.filter(pa.array(known)), len(model.sums), np.int64))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(known, w.shape[1], 0))]), pa.int32()),
                    pa.array(w.ravel()),
                    mask=pa.array(~known),
                )
                columns = [part.column(f.name) for f in schema.fields[:-1]] + [lists]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    names = [f.name for f in schema.fields[:-1]]
    return vectors.select(*names).mapInArrow(run, schema)


def identity_error(vectors: DataFrame, model: Whitening, vector_col: str = "vector") -> float | None:
    """How far the covariance of the whitened rows is from the identity, in its worst entry.

    Computed over all rows in another pass: per block around its own mean, blocks then joined
    with what their means differ by.
    """

    def moments(x: np.ndarray):
        middle = x.mean(0)
        return len(x), middle, (x - middle).T @ (x - middle)

    def merge(a, b):
        (n, mean, square), (m, other, more) = a, b
        step = other - mean
        total = n + m
        return total, mean + step * (m / total), square + more + np.outer(step, step) * (n * (m / total))

    def add(state, batch: pa.RecordBatch):
        x = matrix(batch.column(vector_col), len(model.sums), np.int64)
        for at in range(0, len(x), BLOCK):
            here = moments(model.whitened(x[at : at + BLOCK]))
            state = here if state is None else merge(state, here)
        return state

    if not len(model.eigenvalues):
        return None
    rows = _complete(vectors, vector_col).select(F.col(vector_col).cast("array<bigint>").alias(vector_col))
    found = fold(rows, add, merge)
    if found is None:
        return None
    count, _, square = found
    return float(np.abs(square / count - np.eye(len(square))).max())


def whitened_components(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "vector", components: int = 32
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    ``vectors`` has integer vectors.  ``n`` is their number, ``deviation`` the exact sum over
    dimensions of (n * x - sum)^2, an error beyond 64 bits; ``explained`` is the component's share of
    the variance.  Components are numbered from 1 by falling variance, ``components`` of them at
    most; those without variance are left out, so that a table of equal vectors, like an empty
    one, has no rows.  Vectors that are null or hold null take no part; a null or repeated id is
    kept as it is.  Other columns are not returned.
    """
    rows = _complete(vectors, vector_col).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<bigint>").alias("vector")
    )
    columns = "n long, deviation long, component int, whitened double, explained double, identity_error double"
    model = fit_whitening(rows, "vector", components)
    if model is None or not len(model.eigenvalues):
        kind = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"id {kind}, {columns}").select(
            F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"
        )
    error = identity_error(rows, model, "vector")
    n = F.lit(model.count).cast("long")
    sums = F.array(*(F.lit(int(s)).cast("long") for s in model.sums))
    # a vector that ends early has zeros there; products beyond 64 bits fail in ANSI mode
    spread = F.aggregate(
        F.zip_with("vector", sums, lambda x, s: n * F.coalesce(x, F.lit(0).cast("long")) - s),
        F.lit(0).cast("long"),
        lambda total, d: total + d * d,
    )
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues))
    return (
        whiten(rows, model, "vector")
        .withColumn("deviation", spread)
        .select(F.col("id").alias(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            id_col, (F.col("at") + 1).alias("component"), n.alias("n"), "deviation", "whitened",
            shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
        )
    )
