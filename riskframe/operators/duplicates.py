"""Duplicate rows and duplicate identifiers."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.ranking import sum_or_zero
from riskframe.session import scratch_path

MAX_BROADCAST_HASHES = 1_000_000  # 8 bytes each
NARROW_COLUMNS = 4  # rows of so few columns are not worth hashing


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row that knows which of its values are missing (the built-in skips NULL)."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def _beyond_first(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("__n"))
    return grouped.agg(sum_or_zero(F.col("__n") - 1).alias("duplicate_rows"))


def duplicate_row_count(df: DataFrame, *, direct: bool = False) -> int:
    """Rows beyond the first occurrence of an identical row (missing equals missing).

    Wide rows shuffle as 8-byte hashes first; only rows whose hash repeats are compared in full,
    and without repeated hashes there is nothing more to do. Narrow rows, or very many repeated
    hashes, use the full-row grouping, where equal rows are combined before the shuffle.
    """
    if not direct and len(df.columns) > NARROW_COLUMNS:
        digest = row_hash(df).alias("__h")
        hashes = df.select(digest).groupBy("__h").agg(F.count("*").alias("__n"))
        repeated = hashes.filter("__n > 1").select("__h").persist()
        try:
            suspects = repeated.count()
            if suspects == 0:
                return 0
            if suspects <= MAX_BROADCAST_HASHES:
                checked = df.select("*", digest).join(F.broadcast(repeated), "__h", "left_semi").drop("__h")
                return int(_beyond_first(checked, df.columns).first()[0])
        finally:
            repeated.unpersist()
    return int(_beyond_first(df, df.columns).first()[0])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, moving only rows that may have a copy.

    Counts 8-byte row hashes first. Rows with a unique hash are distinct and pass through where
    they are; only the others are grouped. Falls back to the full-row grouping when very many
    hashes repeat. Unlike ``dropDuplicates`` this runs a job at once.
    """
    digest = row_hash(df).alias("__h")
    hashes = df.select(digest).groupBy("__h").agg(F.count("*").alias("__n"))
    # a written table rather than a cache: nothing to release later, and the planner knows its size
    path = scratch_path(df.sparkSession, "repeated-hashes")
    hashes.filter("__n > 1").select("__h").write.parquet(path)
    repeated = df.sparkSession.read.parquet(path)
    suspects = repeated.count()
    if suspects == 0:
        return df
    if suspects > MAX_BROADCAST_HASHES:
        return df.dropDuplicates()
    hashed = df.select("*", digest)
    unique = hashed.join(F.broadcast(repeated), "__h", "left_anti").drop("__h")
    copies = hashed.join(F.broadcast(repeated), "__h", "left_semi").drop("__h").dropDuplicates()
    return unique.unionByName(copies)


def duplicate_id_counts(df: DataFrame, id_columns: Sequence[str]) -> dict[str, int]:
    """Per identifier column, values after their first occurrence (NULL counts as a value)."""
    if not id_columns:
        return {}
    parts = [
        _beyond_first(df.select(f"`{c}`"), [c]).select(F.lit(c).alias("column_name"), "duplicate_rows")
        for c in id_columns
    ]
    rows = reduce(DataFrame.unionAll, parts).collect()
    return {row.column_name: int(row.duplicate_rows) for row in rows}
