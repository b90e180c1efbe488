"""Vector arithmetic as Spark columns.

Two kinds. Pair functions (``cosine``, ``l2_distance``, ``inner_product``) take two vector columns and
stay in the JVM. ``query_nearness`` compares one query vector with a column: it reads the Arrow buffer
as one matrix, so a whole batch costs one NumPy product. All arithmetic is in double.

Scores: higher is better for every metric. COS is the cosine (0 for a zero vector), IP the dot
product, L2 is ``1 / (1 + distance)``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from vectable.table import COSINE, EUCLIDEAN, INNER_PRODUCT, check_metric, check_vector


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 where either vector is zero (a plain division by zero would raise in ANSI mode)."""
    dot = inner_product(a, b)
    return F.when(dot.isNotNull(), F.coalesce(F.try_divide(dot, norm(a) * norm(b)), F.lit(0.0)))


def l2_distance(a: Column, b: Column) -> Column:
    def squared(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_total(F.zip_with(a, b, squared)))


def score(metric: str, a: Column, b: Column) -> Column:
    """Ranking score of two vector columns under ``metric``."""
    check_metric(metric)
    if metric == COSINE:
        return cosine(a, b)
    if metric == INNER_PRODUCT:
        return inner_product(a, b)
    return F.lit(1.0) / (F.lit(1.0) + l2_distance(a, b))


def normalised(a: Column) -> Column:
    """Unit vector of ``a`` in double; a zero vector stays zero. The norm is bound once per row: written
    inside the inner lambda it would be computed for every element."""

    def scaled(row: Column) -> Column:
        return F.transform(row["v"], lambda x: F.coalesce(F.try_divide(x.cast("double"), row["n"]), F.lit(0.0)))

    bound = F.array(F.struct(a.alias("v"), norm(a).alias("n")))
    return F.transform(bound, scaled)[0]


def is_valid(v: Column, dims: int | None) -> Column:
    """True for a vector of ``dims`` finite elements, False (never NULL) otherwise.

    ``array_contains`` is NULL when the array holds a NULL and not the value, so one call covers the
    NULL elements; NaN sorts above infinity, so ``array_max`` covers NaN and +Inf. No lambda: all of
    it is generated code.
    """
    inf = float("inf")
    finite = (
        (F.array_max(v) < F.lit(inf))
        & (F.array_min(v) > F.lit(-inf))
        & ~F.array_contains(v.cast("array<double>"), F.lit(inf))
    )
    right_size = F.size(v) == F.lit(dims) if dims is not None else F.size(v) > F.lit(0)
    return F.coalesce(v.isNotNull() & right_size & finite, F.lit(False))


# ---- helpers that run inside tasks, on one Arrow batch at a time ----------------------------------


def to_matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, matrix) of the usable vectors in an Arrow list column: right length, all finite."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if (lengths == dims).all():
        matrix, positions = values.reshape(len(column), dims), np.arange(len(column))
    else:
        starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
        positions = np.flatnonzero(lengths == dims)
        matrix = values[starts[positions][:, None] + np.arange(dims)[None, :]]
    finite = np.isfinite(matrix).all(axis=1)
    return (positions, matrix) if finite.all() else (positions[finite], matrix[finite])


def row_norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix * matrix).sum(axis=1))


def row_nearness(metric: str, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosine, dot product, or minus the distance of each row with the query beside it. Summed row by
    row, so equal vectors get equal values wherever they stand in a batch."""
    if metric == EUCLIDEAN:
        gap = rows - queries
        return -np.sqrt((gap * gap).sum(axis=1))
    dots = (rows * queries).sum(axis=1)
    if metric == INNER_PRODUCT:
        return dots
    norms = row_norms(rows) * row_norms(queries)
    return np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)


def query_nearness(vector_col: Column, query: Sequence[float], metric: str = COSINE) -> Column:
    """Nearness of a vector column to one query: cosine, dot product, or minus the distance. NULL where
    the stored vector is unusable."""
    check_metric(metric)
    target = np.asarray(check_vector(query), dtype=np.float64)[None, :]

    @F.arrow_udf("double")
    def compared(column: pa.Array) -> pa.Array:
        positions, matrix = to_matrix(column, target.shape[1])
        out = np.full(len(column), np.nan)
        out[positions] = row_nearness(metric, matrix, np.broadcast_to(target, matrix.shape))
        return pa.array(out, mask=np.isnan(out))

    return compared(vector_col)
