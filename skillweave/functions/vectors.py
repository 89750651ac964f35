"""Vector arithmetic on ``array<float>`` / ``array<double>`` columns, always in double."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_FLOOR = 1e-12


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vector), F.lit(0.0), lambda s, v: s + v * v))


def l2_normalise(vector: Column) -> Column:
    """Unit-length copy; the norm is floored, so a zero vector stays zero."""
    scaled = F.transform(
        F.array(F.greatest(norm(vector), F.lit(NORM_FLOOR))),
        lambda length: F.transform(as_double(vector), lambda x: x / length),
    )
    return scaled[0]


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either side is the zero vector."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.lit(0.0))


def to_matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Arrow list column of equal-length vectors to a dense float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 0))


def from_matrix(matrix: np.ndarray) -> pa.ListArray:
    """Dense matrix to an Arrow ``list<double>`` column."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32) if width else np.zeros(rows + 1, np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).reshape(-1)))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
