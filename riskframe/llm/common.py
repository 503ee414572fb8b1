"""Shared helpers: scratch tables in the cluster's shared folder and byte-bounded Arrow slices."""

from __future__ import annotations

import ctypes
import functools
import gc
from typing import Callable, Iterator, TypeVar

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

T = TypeVar("T")
#: Words of every operator: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column):
    """A-Z lower-cased, everything else as it is (the same in every SQL engine)."""
    return F.translate(column, UPPER, LOWER)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors.

    Reading it back gives the planner the true size, so it broadcasts only what is small. The shuffle files of
    the write are removed with its end, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove scratch tables of :func:`written` once all that needs them is written itself."""
    for df in tables:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    """Partitions of a shuffle as the session sizes them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_memory() -> None:
    """Give what earlier tasks of this Python worker have freed back to the machine: workers live through many stages.

    The modules of the worker are searched for garbage the first time only, which takes 40 ms and more.
    """
    gc.collect()
    if not gc.get_freeze_count():
        gc.freeze()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(task: Callable[..., Iterator[T]]) -> Callable[..., Iterator[T]]:
    """A task's generator that gives back its memory when it ends, as the idle worker stays beside the next stages."""

    @functools.wraps(task)
    def run(*args):
        free_memory()
        yield from task(*args)
        free_memory()

    return run


def tidy_cogroup(task: Callable) -> Callable:
    """The same for a function of two groups, which is called once per group."""

    def run(key, left, right):
        out = task(key, left, right)
        free_memory()
        return out

    return run


_resident: dict = {}


def resident(key, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept for later tasks of this Python worker. A worker keeps one such thing at a time: it
    lives through many stages, and the next operator needs the room."""
    if key not in _resident:
        _resident.clear()
        free_memory()
        _resident[key] = make()
    return _resident[key]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``limit`` bytes of ``column`` or a single row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy()
        ends = lengths.cumsum(dtype="int64")
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(ends.searchsorted(base + limit, side="right")))
            yield batch.slice(start, stop - start)
            base, start = int(ends[stop - 1]), stop
