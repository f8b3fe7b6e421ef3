"""Vector arithmetic: columns for single pairs, NumPy for blocks inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

# Scores are ranked after rounding, so that equal documents tie whatever order their terms were summed in.
RANK_DECIMALS = 9


def dot_col(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm_col(a: Column) -> Column:
    return F.sqrt(dot_col(a, a))


def cosine_col(a: Column, b: Column) -> Column:
    """Cosine of two vector columns in double precision; 0 when either is the zero vector."""
    length = norm_col(a) * norm_col(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(dot_col(a, b) / length)


def unit_rows(vectors) -> np.ndarray:
    """Vectors as rows of length 1; zero vectors stay zero, so their cosine is 0."""
    rows = [np.asarray(v, dtype=np.float64) for v in vectors]
    if not rows:
        return np.empty((0, 0))
    return _unit(np.stack(rows))


def unit_column(column) -> np.ndarray:
    """The same for an Arrow column of lists, without an object for each vector."""
    if not len(column):
        return np.empty((0, 0))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any():
        raise ValueError("all vectors must have the same length")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return _unit(values.reshape(len(column), int(lengths[0])))


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)
