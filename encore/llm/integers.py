"""Integer vectors: `floor(scale * component)` of stored float vectors, and their blocks in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Larger components would not leave room for sums of products in a long.
LARGEST = 1 << 31


def usable(vector: str) -> Column:
    """The vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(True))


def integers(vector: str, scale: int) -> Column:
    """`floor(scale * x)` of every component, taken as double. A result of LARGEST or more in magnitude is an error."""
    wide = F.transform(vector, lambda x: scale * x.cast("double"))
    fail = F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("array<bigint>")
    return F.when(F.exists(wide, lambda x: F.abs(x) >= LARGEST), fail).otherwise(F.transform(wide, lambda x: F.floor(x).cast("long")))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equal length as an int64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)
