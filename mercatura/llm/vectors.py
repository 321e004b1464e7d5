"""Vectors of a table as matrices of whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, number), F.lit(False))


def whole(flat: np.ndarray, scale: int, limit: float) -> np.ndarray:
    """floor(scale * x) as doubles; a result of ``limit`` or more raises OverflowError."""
    with np.errstate(over="ignore"):
        found = np.floor(scale * flat.astype(np.float64))
    if len(found) and not np.abs(found).max() < limit:
        raise OverflowError("a component is too large for exact whole numbers")
    return found


def matrices(column: pa.Array, scale: int, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector in a batch: the rows that have it, and their whole numbers by rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = whole(column.flatten().to_numpy(zero_copy_only=False), scale, limit)
    offsets = column.offsets.to_numpy()
    sizes, starts = np.diff(offsets), offsets[:-1] - offsets[0]
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows, None] + np.arange(size)]
