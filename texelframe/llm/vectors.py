"""Columns of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector isn't null or zero and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """Rows of equal length, in double precision unless another kind of number is asked for."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1)


def by_length(column: pa.Array, kind: type = np.float64) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: which rows, and their matrix."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        out.append((rows, matrix(column.take(pa.array(rows)), kind)))
    return out
