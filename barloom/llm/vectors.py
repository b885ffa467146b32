"""Vectors of a table as a matrix, and what makes a vector usable."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """True for vectors without NULL or non-finite components that are not zero."""
    v = F.col(column)
    big = F.lit(float("inf"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == big))
    some = F.exists(v, lambda x: x != 0)
    return F.coalesce(v.isNotNull() & ~bad & some, F.lit(False))


def common_dimension(vectors: DataFrame) -> int:
    """The length of the vectors; 0 for an empty table. Different lengths are an error."""
    row = vectors.agg(F.min(F.size("embedding")).alias("a"), F.max(F.size("embedding")).alias("b")).first()
    if row["a"] != row["b"]:
        raise ValueError(f"vectors have {row['a']} to {row['b']} components")
    return row["a"] or 0


def matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """Rows of a list column, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dimension)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by their largest component, so that nothing overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosine_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, summed in one fixed order."""
    return (unit(a) * unit(b)).sum(axis=1)
