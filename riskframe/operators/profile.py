"""Dataset profile: size, types, missing values, duplicates, target distribution, statistics."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import flag, to_number
from riskframe.functions.ranking import double_key, exact_quantiles, sum_or_zero
from riskframe.operators.cleaning import numeric_columns
from riskframe.operators.duplicates import duplicate_row_count
from riskframe.session import local_frame


def missing_predicate(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in floating columns."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def missing_values(df: DataFrame) -> DataFrame:
    """Long table ``(column_name, missing, rows)`` from a single aggregate."""
    names = df.columns
    sums = [sum_or_zero(flag(missing_predicate(df, c))).alias(f"m{i}") for i, c in enumerate(names)]
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing"), F.col("rows").alias("rows"))
            for i, c in enumerate(names)
        ]
    )
    return df.agg(F.count("*").alias("rows"), *sums).select(F.inline(entries))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """``(target, rows)`` including a group for missing."""
    return df.groupBy(F.col(f"`{target}`")).agg(F.count("*").alias("rows"))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, count, mean, std, min, p25, p50, p75, max)`` of the numeric columns.

    Moments come from one aggregate; quartiles are exact and linearly interpolated.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    spark = df.sparkSession
    schema = (
        "column_name string, count long, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double"
    )
    if not names:
        return local_frame(spark, [], schema)
    numbers = df.select(*[to_number(F.col(f"`{c}`")).alias(c) for c in names])
    moments: list[Column] = []
    for i, name in enumerate(names):
        value = F.col(f"`{name}`")
        moments += [
            F.count(value).alias(f"n{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
        ]
    row = numbers.agg(*moments).first()
    counts = {name: row[f"n{i}"] for i, name in enumerate(names)}
    ranges = {c: (counts[c], double_key(row[f"min{i}"]), double_key(row[f"max{i}"])) if counts[c] else (0, None, None)
              for i, c in enumerate(names)}
    quartiles = exact_quantiles(numbers, names, (0.25, 0.5, 0.75), ranges=ranges)
    rows = []
    for i, name in enumerate(names):
        p25, p50, p75 = quartiles[name] or (None, None, None)
        rows.append(
            (name, counts[name], row[f"mean{i}"], row[f"std{i}"], row[f"min{i}"], p25, p50, p75, row[f"max{i}"])
        )
    return local_frame(spark, rows, schema)


@dataclass(frozen=True)
class DatasetAnalysis:
    """Profile of one dataset; ``numeric_summary`` has one row per numeric column."""

    rows: int
    columns: int
    duplicate_rows: int
    dtypes: dict[str, str]
    missing_values: dict[str, int]
    target_distribution: dict[Any, int] | None
    numeric_summary: DataFrame


def analyze_dataset(df: DataFrame, *, target_column: str | None = None) -> DatasetAnalysis:
    """Profile a table in a fixed number of jobs, independent of its width."""
    if not isinstance(df, DataFrame):
        raise TypeError("df must be a Spark DataFrame")
    if target_column is not None and target_column not in df.columns:
        raise ValueError(f"target column '{target_column}' is missing")
    distribution = None
    if target_column is not None:
        distribution = {r[0]: r["rows"] for r in target_distribution(df, target_column).collect()}
    missing = missing_values(df).collect()
    return DatasetAnalysis(
        rows=missing[0]["rows"],
        columns=len(df.columns),
        duplicate_rows=duplicate_row_count(df),
        dtypes=dict(df.dtypes),
        missing_values={r["column_name"]: r["missing"] for r in missing},
        target_distribution=distribution,
        numeric_summary=numeric_summary(df),
    )


class DatasetAnalyzer:
    """Object form of :func:`analyze_dataset`."""

    def __init__(self, *, target_column: str | None = None) -> None:
        self.target_column = target_column

    def analyze(self, df: DataFrame) -> DatasetAnalysis:
        return analyze_dataset(df, target_column=self.target_column)
