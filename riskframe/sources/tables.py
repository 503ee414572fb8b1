"""Reading and writing: files by suffix, catalog tables, history tables, upserts."""

from __future__ import annotations

from pathlib import PurePosixPath
from typing import Any, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.session import active_session

FORMATS = {"csv": "csv", "parquet": "parquet", "pq": "parquet", "json": "json", "jsonl": "jsonl"}
WRITE_MODES = ("overwrite", "append", "merge")


def load_dataset(
    source: str | DataFrame,
    *,
    spark: SparkSession | None = None,
    file_format: str | None = None,
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Table from a DataFrame, a CSV / Parquet / JSON / JSON-lines path, or a catalog name.

    Give ``schema`` for large CSV and JSON: inferring it is one more pass over the files.
    """
    if isinstance(source, DataFrame):
        return source
    name = str(source)
    suffix = PurePosixPath(name.rstrip("/")).suffix.lstrip(".")
    kind = FORMATS.get((file_format or suffix).lower())
    if kind is None:
        session = spark or SparkSession.getActiveSession()
        if session is not None and not file_format and _is_table_name(name):
            return session.table(name)
        raise ValueError(
            "unsupported dataset source: use a CSV, Parquet, JSON or JSON-lines path, "
            "a DataFrame, or a catalog table name"
        )
    reader = active_session(spark).read
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    elif kind == "json":
        reader = reader.option("multiLine", True)
    reader = reader.options(**options)
    return reader.format("json" if kind in ("json", "jsonl") else kind).load(name)


def _is_table_name(name: str) -> bool:
    return "/" not in name and all(part for part in name.split("."))


class DatasetLoader:
    """Object form of :func:`load_dataset`."""

    def __init__(self, *, spark: SparkSession | None = None, file_format: str | None = None, **options: Any) -> None:
        self.spark = spark
        self.file_format = file_format
        self.options = options

    def load(self, source: str | DataFrame) -> DataFrame:
        return load_dataset(source, spark=self.spark, file_format=self.file_format, **self.options)


def _is_path(name: str) -> bool:
    return "/" in name


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Catalog table, or Parquet files when the name is a path."""
    df = spark.read.parquet(name) if _is_path(name) else spark.table(name)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, name: str, *, mode: str = "overwrite", table_format: str = "parquet") -> None:
    """Write to a catalog table, or to files when the name is a path."""
    if mode not in ("overwrite", "append", "error", "ignore"):
        raise ValueError(f"unsupported write mode {mode!r}")
    writer = df.write.format(table_format).mode(mode)
    if table_format == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.save(name) if _is_path(name) else writer.saveAsTable(name)


def append_history(df: DataFrame, path: str) -> None:
    """Append to a history location; later batches may bring new columns."""
    df.write.mode("append").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch of a history, below ``batch_id=N``: a batch that is replayed replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a history location, absent columns as NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def upsert(old: DataFrame, new: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """``new`` replaces rows of ``old`` with the same identifiers; the rest stays.

    Identifiers compare NULL-safe. Both sides shuffle on the identifiers unless one is small. Without
    identifiers nothing says which rows to replace, so that raises. New rows that repeat an identifier all stay.
    """
    if not id_columns:
        raise ValueError("an upsert needs at least one identifier column")
    left, right = old.alias("old"), new.select(*id_columns).distinct().alias("new")
    same = None
    for name in id_columns:
        match = F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
        same = match if same is None else same & match
    return left.join(right, same, "left_anti").unionByName(new, allowMissingColumns=True)


def write_merge(spark: SparkSession, new: DataFrame, old_path: str, out_path: str, id_columns: Sequence[str]) -> None:
    """Upsert into a new location (files being read must not be overwritten)."""
    upsert(spark.read.parquet(old_path), new, id_columns).write.mode("overwrite").parquet(out_path)


def scoring_table(df: DataFrame, target: str) -> DataFrame:
    """The table without its label."""
    return df.drop(target)


def sampled_read(df: DataFrame, *, rows: int | None = None, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """The first rows, or a seeded random fraction."""
    if fraction is not None:
        return df.sample(fraction=fraction, seed=seed)
    return df.limit(rows) if rows is not None else df


def to_spark(rows: Any, schema: T.StructType | str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Local rows (tuples, dicts or a pandas frame) as a table; a DataFrame passes through."""
    if isinstance(rows, DataFrame):
        return rows
    if isinstance(rows, Iterable) and not hasattr(rows, "columns"):
        rows = list(rows)
    return active_session(spark).createDataFrame(rows, schema)


def to_pandas(df: DataFrame, *, sample_size: int):
    """A bounded preview as a pandas frame; there is no unbounded conversion."""
    return df.limit(sample_size).toPandas()
