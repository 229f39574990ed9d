"""Helpers for columns of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_numbers(df: DataFrame, vector_col: str) -> tuple[Column, str]:
    """The column as an array of floats or doubles, and numpy's name of the type."""
    of = df.schema[vector_col].dataType
    if isinstance(of, T.ArrayType) and isinstance(of.elementType, T.FloatType):
        return F.col(vector_col), "<f4"
    return F.col(vector_col).cast("array<double>"), "<f8"


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors) for every length there is.  Rows that are
    null, empty, or hold null or non-finite components are in none."""
    begins = column.offsets.to_numpy()
    sizes = np.diff(begins)
    fine = column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    if column.values.null_count:
        holes = np.concatenate([[0], np.cumsum(column.values.is_null().to_numpy(zero_copy_only=False))])
        fine &= holes[begins[1:]] == holes[begins[:-1]]
    flat = column.values.fill_null(0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[fine]):
        rows = np.flatnonzero(fine & (sizes == size))
        found = flat[begins[rows][:, None] + np.arange(size)]
        finite = np.isfinite(found).all(axis=1)
        yield rows[finite], found[finite]


def binaries(values: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    width = values.shape[1] * values.itemsize
    flat = np.ascontiguousarray(values).tobytes()
    return pa.array([flat[i:i + width] for i in range(0, len(flat), width)], pa.binary())


def unbinaries(column: pa.Array, dtype: str) -> np.ndarray:
    """The rows of ``binaries``, all of one length, as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1).astype(np.float64)
