"""Integer inner products without rounding, whatever their size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F



def floored(vector: str, scale: int) -> Column:
    """floor(scale * x) of each component, x as double, in 64 bits; a component beyond them is an error."""
    def whole(x: Column) -> Column:
        found = F.floor(x.cast("double") * scale)
        most = F.abs(x.cast("double") * scale) < float(1 << 62)
        return F.when(most, found).otherwise(F.raise_error(F.lit("a scaled component is beyond 64 bits")).cast("bigint"))

    return F.transform(vector, whole)


def most_score(left: np.ndarray, right: np.ndarray) -> float:
    """A bound on the size of any inner product of rows."""
    if not left.size or not right.size:
        return 0.0
    return float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of int64 matrices, exact; a product beyond 64 bits is an error."""
    most = most_score(left, right)
    if most < 2.0 ** 52:  # exact in doubles, and fast
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most < 2.0 ** 62:
        return left @ right.T
    # in integers of any size
    found = left.astype(object) @ right.astype(object).T
    if found.size and max(abs(int(found.min())), abs(int(found.max()))) >= 1 << 63:
        raise OverflowError("an inner product is beyond 64 bits")
    return found.astype(np.int64)


def integers(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of lists of 64-bit integers as a matrix; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes, flat = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out
