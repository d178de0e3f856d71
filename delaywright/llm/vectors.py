"""Vectors in Arrow and numpy: picking valid rows, matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_valid() -> Column:
    """Whether a row has an id and a vector that is not null, empty or zero and holds only finite
    components (columns ``vec_id`` and ``embedding``)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x.isNotNull() & (x != 0))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & some
    return F.coalesce(usable, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of an array column of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaling by the largest component first keeps squares in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
