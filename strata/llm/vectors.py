"""Vectors of whole numbers: the columns and the matrices that operators 11 and 12 share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers (never null)."""
    return F.coalesce(
        F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))),
        F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` of every component c, as longs (the ends of the long range beyond it)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as 64-bit integers; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def largest(m: np.ndarray) -> int:
    """The largest absolute value, as a Python integer."""
    return max(int(m.max(initial=0)), -int(m.min(initial=0)))
