"""Vectors as matrices in tasks: cleaning, packing into blocks, and pairing of blocks without a cross join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """(id, vector array<double>, others): rows whose vector is not null, empty, zero or holding null or non-finite values."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector"), *[F.col(f"`{c}`").alias(c) for c in others])
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(
        ~bad & F.exists("vector", lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
