"""Vector columns as integer matrices, for code that runs inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vec: Column) -> Column:
    """A vector that is not null and holds neither null nor non-finite entries."""
    inf = float("inf")
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != inf)
    return vec.isNotNull() & F.coalesce(F.forall(vec, entry), F.lit(False))


def scaled(vec: Column, factor: int, plus: int = 0) -> Column:
    """floor(factor * entry) + plus of every entry, computed in doubles, as long."""
    return F.transform(vec, lambda c: F.floor(c.cast("double") * F.lit(float(factor))) + F.lit(plus).cast("bigint"))


def matrix(lists: pa.Array, dtype=np.int64) -> np.ndarray:
    """Lists of one length without nulls as a matrix, one row per list."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(lists), -1)


def lists(rows: np.ndarray) -> pa.Array:
    """A matrix as lists, one per row."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(rows).ravel()))
