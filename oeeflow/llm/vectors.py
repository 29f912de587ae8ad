"""Vectors of a table as fixed-width binary columns, for operators that work on blocks of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """The vector is there and holds no null, NaN or infinite component."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def width(df: DataFrame, vec: str) -> int:
    """Components of the longest vector (shorter ones count as followed by zeros); 1 at least."""
    return max(1, df.agg(F.max(F.size(vec))).first()[0] or 0)


def matrix(column: pa.Array, dtype) -> np.ndarray:
    """A binary column of equally long vectors as a matrix, one row each."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1) if rows else np.zeros((0, 1), dtype)


def padded(lists: pa.Array, dims: int, dtype) -> np.ndarray:
    """A list column as a matrix of ``dims`` columns, filled up with zeros."""
    n = len(lists)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    ends = np.diff(lists.offsets.to_numpy())
    if n and (ends == dims).all():
        return flat.reshape(n, dims)
    out = np.zeros((n, dims), dtype)
    row = np.repeat(np.arange(n), ends)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)] = flat
    return out


def binary_rows(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as a binary column."""
    m = np.ascontiguousarray(m)
    size = m.shape[1] * m.itemsize
    data = m.tobytes()
    return pa.array([data[i * size:(i + 1) * size] for i in range(len(m))], pa.binary())
