"""Helpers for vectors: whole-number components, and Arrow columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums of products of up to this size are exact in the 64-bit floats that matrix products use.
EXACT = 2**53


def is_clean(vector: str | Column) -> Column:
    """Whether a vector is there and has no null and no infinite or undefined component."""
    inf = float("inf")
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < inf)), F.lit(False))


def floored(vector: str | Column, scale: int = 256) -> Column:
    """array<bigint> of floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def largest(vector: str | Column) -> Column:
    """The greatest size of a component; 0 of an empty vector."""
    return F.coalesce(F.array_max(F.transform(vector, lambda x: F.abs(x))), F.lit(0))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A column of lists of `dims` numbers as rows of floats."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)


def lists(values: np.ndarray) -> pa.Array:
    """Rows of whole numbers as a column of lists."""
    n, dims = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dims, dims) if dims else np.zeros(n + 1), pa.int32()), pa.array(values.astype(np.int64).ravel()))


def squared(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of each point to each of `to`; exact for whole numbers up to EXACT."""
    return (points**2).sum(axis=1)[:, None] + (to**2).sum(axis=1)[None, :] - 2 * (points @ to.T)
