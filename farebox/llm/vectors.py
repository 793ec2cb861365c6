"""What the vector operators share: which rows take part, and the vectors of a batch as one matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Above this a double no longer holds every integer.
EXACT = 1 << 53


def finite(vector: Column) -> Column:
    """True where a vector is there and all its components are numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    """The vectors of an Arrow list column as rows of a matrix, filled up with zeros to ``width``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], column.type)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), kind)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(k) for k in sizes] or [np.arange(0)])] = flat
    return out
