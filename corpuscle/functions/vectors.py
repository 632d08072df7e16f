"""Vector arithmetic: column expressions and Arrow-to-numpy helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are ranked after rounding to this many digits, so that equal vectors
# tie exactly whatever block of a matrix product they were computed in.
SCORE_DIGITS = 12


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product, for narrow use; bulk products run on matrices."""
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(vector), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit vector of the same direction; the zero vector stays zero."""
    # The norm is a second array, computed once, not part of the lambda.
    norms = F.array_repeat(l2_norm(vector), F.size(vector))
    return F.zip_with(as_doubles(vector), norms, lambda x, norm: F.when(norm > 0, x / norm).otherwise(x))


def mean_vector(vector: Column) -> Column:
    """Aggregate: element-wise mean, combined map-side."""
    return vector_to_array(Summarizer.mean(array_to_vector(vector)))


def sum_vector(vector: Column) -> Column:
    """Aggregate: element-wise sum, combined map-side."""
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a float64 matrix; see ``stored_matrix``."""
    return stored_matrix(column).astype(np.float64, copy=False)


def stored_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a matrix of the stored type, without a copy of the numbers.

    Null vectors, null components and vectors of different length have no place
    in a matrix and raise; drop such rows before.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("a vector is null")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any():
        raise ValueError(f"vectors have different lengths: {lengths.min()} to {lengths.max()}")
    if column.flatten().null_count:
        raise ValueError("a component of a vector is null")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def list_column(values: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as a list column of doubles."""
    rows, width = values.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32) if width else np.zeros(rows + 1, np.int32)
    flat = pa.array(np.ascontiguousarray(values, dtype=np.float64).ravel())
    return pa.ListArray.from_arrays(pa.array(offsets), flat)
