"""Vector columns as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Components from here on are refused: sums of their products could leave 64 bits.
LARGEST = 1 << 26


def whole(vector: str) -> Column:
    """True where a vector is there and none of its components is null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def floors(vector: str, scale: int = 256) -> Column:
    """floor(scale * component) of each component, as bigints."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def widest(df: DataFrame, vector: str) -> int:
    """Components of the longest vector, 0 without rows."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an integer list column; shorter ones end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(column.offsets.to_numpy())
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST} or more after scaling are not taken")
    if (size == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out
