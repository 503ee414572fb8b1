"""Exact order statistics, cut keys and dense codes without a single-task sort.

Searches work on keys of 64 bits (numbers) or 32 hexadecimal digits (hashes) whose order is that of the values. A round is
one grouped count of key prefixes, combined before the shuffle; running totals per interval find the prefixes in which the
wanted ranks fall, and only those are told apart further. Rows are never sorted or collected.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import to_number
from riskframe.session import ensure_checkpoint_dir, local_frame, scratch_path

ROUND_COUNTERS = 1 << 20  # counters of one round over all open intervals
MIN_DIGIT_BITS, MAX_DIGIT_BITS = 10, 14
HEX_DIGITS_PER_LEVEL = 3
KEY_DIGITS = 32
LAST_ROUND_ROWS = 1 << 16  # a group that has no more rows left is ranked row by row
HEAD_DIGITS = 15  # leading digits of a hash key that fit a long


def sum_or_zero(values: Column) -> Column:
    return F.coalesce(F.sum(values), F.lit(0))


# ---- keys of numbers -----------------------------------------------------------------------


def double_key(value: float) -> int:
    """Whole number that orders as the double does (0.0 and -0.0 are one)."""
    bits = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return bits if value > 0 else -bits


def key_double(key: int) -> float:
    """The double of a key."""
    value = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return value if key >= 0 else -value


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType)


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only ``columns``: whole numbers as longs, everything else as doubles. Missing, NaN and unreadable values are NULL."""
    def number(c: str) -> Column:
        value, kind = F.col(f"`{c}`"), df.schema[c].dataType
        if _whole(kind):
            return value.cast("long")
        return to_number(value.cast("int") if isinstance(kind, T.BooleanType) else value)

    return df.select(*[number(c).alias(f"k{i}") for i, c in enumerate(columns)])


def _maker() -> Callable[[np.ndarray], np.ndarray]:
    """The function from longs or doubles to keys. Functions for tasks are made here and below, as closures: they travel
    whole, so executors need no copy of this package."""

    def keys_of(values: np.ndarray) -> np.ndarray:
        if values.dtype != np.float64:
            return values
        bits = np.abs(values).view(np.int64)
        return np.where(values < 0, -bits, bits)

    return keys_of


def with_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only ``columns``, as keys: whole numbers as they are, everything else as the bits of its double."""
    keys_of = _maker()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [pa.array(keys_of(c.fill_null(0).to_numpy(zero_copy_only=False)), pa.int64(), mask=c.is_null().to_numpy(zero_copy_only=False))
                    for c in batch.columns]
            yield pa.RecordBatch.from_arrays(keys, names=batch.schema.names)

    return _numbers(df, columns).mapInArrow(make, ", ".join(f"k{i} long" for i in range(len(columns))))


# ---- order statistics ----------------------------------------------------------------------


@dataclass(frozen=True)
class Found:
    """The key at a rank, how many rows lie below it, and how many have it."""

    key: int
    below: int
    equal: int


@dataclass(frozen=True)
class _Interval:
    """Keys ``low`` to ``high`` (both occur) of a column, with ``below`` rows under them and the ranks that fall inside."""

    column: int
    low: int
    high: int
    below: int
    rows: int
    ranks: tuple[int, ...]

    def shift(self, bits: int) -> int:
        """Low bits to leave out so that at most ``2 ** bits`` prefixes remain."""
        shift = 0
        while (self.high >> shift) - (self.low >> shift) >= 1 << bits:
            shift += 1
        return shift


def _round(numbers: DataFrame, intervals: Sequence[_Interval]) -> list[_Interval]:
    """One grouped count over all columns: the narrower intervals in which the ranks fall.

    A task counts its rows into arrays, one counter a prefix; what is shuffled are the counters that it used.
    """
    bits = min(MAX_DIGIT_BITS, max(MIN_DIGIT_BITS, (ROUND_COUNTERS // len(intervals)).bit_length() - 1))
    used = sorted({x.column for x in intervals})
    columns = {c: [number for number, x in enumerate(intervals) if x.column == c] for c in used}
    spans = [(x.low, x.high, x.shift(bits)) for x in intervals]
    keys_of, digits = _maker(), MAX_DIGIT_BITS + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # by prefix: rows, smallest and largest key
        counters = []
        for low, high, shift in spans:
            size = (high >> shift) - (low >> shift) + 1
            counters.append((np.zeros(size, np.int64), np.full(size, high, np.int64), np.full(size, low, np.int64)))
        for batch in batches:
            for c, numbers in columns.items():
                keys = np.sort(keys_of(batch.column(f"k{c}").drop_null().to_numpy(zero_copy_only=False)))
                for number in numbers:
                    low, high, shift = spans[number]
                    own = keys[np.searchsorted(keys, low):np.searchsorted(keys, high, side="right")]
                    if not len(own):
                        continue
                    place = (own >> shift) - (low >> shift)
                    start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                    stop = np.append(start[1:], len(own))
                    (n, least, most), at = counters[number], place[start]
                    n[at] += stop - start
                    least[at] = np.minimum(least[at], own[start])
                    most[at] = np.maximum(most[at], own[stop - 1])
        for number, (n, least, most) in enumerate(counters):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in ((number << digits) + at, n[at], least[at], most[at])], names=["code", "n", "low", "high"])

    coded = numbers.select(*[f"k{c}" for c in used]).mapInArrow(count, "code long, n long, low long, high long")
    counted = coded.groupBy("code").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    counted = counted.withColumn("interval", F.shiftright("code", MAX_DIGIT_BITS + 1).cast("int"))
    below = F.sum("n").over(Window.partitionBy("interval").orderBy("code")) - F.col("n")
    wanted = [(number, rank - x.below) for number, x in enumerate(intervals) for rank in x.ranks]
    targets = local_frame(numbers.sparkSession, wanted, "at int, offset long")  # one row a rank
    hits = counted.withColumn("below", below).join(
        F.broadcast(targets), (F.col("interval") == F.col("at")) & (F.col("offset") >= F.col("below"))
        & (F.col("offset") < F.col("below") + F.col("n"))).collect()
    if len(hits) != len(wanted):
        raise RuntimeError("the input changed between two passes of the search")
    found: dict[tuple[int, int], list] = {}
    for hit in hits:
        found.setdefault((hit["interval"], hit["low"]), []).append(hit)
    out = []
    for (number, low), same in found.items():
        x, hit = intervals[number], same[0]
        ranks = tuple(sorted(x.below + h["offset"] for h in same))
        out.append(_Interval(x.column, low, hit["high"], x.below + hit["below"], hit["n"], ranks))
    return out


def key_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, int | None, int | None]]:
    """(rows with a value, smallest key, largest key) of every column, in one aggregate."""
    if not columns:
        return {}
    keys_of = _maker()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            for i, column in enumerate(batch.columns):
                keys = keys_of(column.drop_null().to_numpy(zero_copy_only=False))
                if len(keys):
                    n, low, high = found.get(i, (0, keys[0], keys[0]))
                    found[i] = n + len(keys), min(low, keys.min()), max(high, keys.max())
        if found:
            columns = zip(*[(i, *x) for i, x in found.items()])
            yield pa.RecordBatch.from_arrays([pa.array(list(map(int, v)), pa.int64()) for v in columns], names=["at", "n", "low", "high"])

    each = _numbers(df, columns).mapInArrow(measure, "at long, n long, low long, high long")
    rows = each.groupBy("at").agg(F.sum("n"), F.min("low"), F.max("high")).collect()
    found = {row[0]: tuple(row)[1:] for row in rows}
    return {c: found.get(i, (0, None, None)) for i, c in enumerate(columns)}


def search_ranks(
    df: DataFrame, ranks: Mapping[str, Iterable[int]], ranges: Mapping[str, tuple[int, int | None, int | None]]
) -> dict[tuple[str, int], Found]:
    """The keys at zero-based ranks of several columns, all searched together.

    Every round reads the columns that are still open once and fixes ten bits or more of every key, fourteen where few
    intervals are open; an interval with a single key is done. That makes five rounds for a few columns and seven at most.
    """
    columns = list(ranks)
    opened, done = [], []
    for i, column in enumerate(columns):
        wanted = tuple(sorted(set(ranks[column])))
        n, low, high = ranges[column]
        if wanted and not (0 <= wanted[0] and wanted[-1] < n):
            raise ValueError(f"column '{column}' has {n} values, ranks asked are {wanted}")
        if wanted:
            (done if low == high else opened).append(_Interval(i, low, high, 0, n, wanted))
    numbers = _numbers(df, columns)
    while opened:
        narrowed = _round(numbers, opened)
        done += [x for x in narrowed if x.low == x.high]
        opened = [x for x in narrowed if x.low != x.high]
    return {(columns[x.column], rank): Found(x.low, x.below, x.rows) for x in done for rank in x.ranks}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    ranges: Mapping[str, tuple[int, int | None, int | None]] | None = None,
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles of many columns; ``None`` for a column without values.

    ``ranges`` (see :func:`key_ranges`) spares a pass where the caller has counted already.
    """
    ranges = ranges if ranges is not None else key_ranges(df, columns)
    positions = {c: [(ranges[c][0] - 1) * p for p in probabilities] for c in columns if ranges[c][0]}
    ranks = {c: {r for x in at for r in (math.floor(x), math.ceil(x))} for c, at in positions.items()}
    found = search_ranks(df, ranks, ranges)
    result: dict[str, list[float] | None] = {c: None for c in columns}
    for column, at in positions.items():
        decode = float if _whole(df.schema[column].dataType) else key_double
        values = []
        for x in at:
            low, high = math.floor(x), math.ceil(x)
            a, b = decode(found[(column, low)].key), decode(found[(column, high)].key)
            values.append(a if a == b else a + (b - a) * (x - low))
        result[column] = values
    return result


def long_order_statistic(df: DataFrame, column: str, rank: int) -> int:
    """Exact k-th smallest value (zero-based rank) of a whole-number column without missing values."""
    return search_ranks(df, {column: [rank]}, key_ranges(df, [column]))[(column, rank)].key


# ---- cuts of groups ------------------------------------------------------------------------

CUT_COLUMNS = ("grp", "rows", "quota", "key", "take", "ties")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written below the shared folder and read again: the search goes on with what is left, at its true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_cuts(keys: DataFrame, quota: Column | DataFrame) -> DataFrame:
    """Per group of ``(grp, key)`` the hexadecimal key that separates its ``quota`` smallest: one row ``(grp, rows, quota,
    key, take, ties)`` for each group, however many there are.

    Keys below ``key`` are chosen, plus ``take`` of the ``ties`` rows on it; the empty key chooses none. Where the quota
    ends behind a prefix, ``key`` is the last key with it and ``take`` equals ``ties``. ``quota`` is an expression over the
    group's size ``rows``, or a table ``(grp, quota)``.

    What moves are the first 15 digits of a key, as a long. Groups of few rows are ranked by them at once, in one shuffle
    by group. In large groups three digits are fixed a round, by counts of prefixes; only rows under the prefix of an open
    group go on, about 1 of 4,096 a round. Where the quota ends among rows that agree in all that was compared, the whole
    keys of these rows are counted. The sizes of the groups, counted first, say which way a group goes. A NULL group is a group.
    """
    named = keys.select(F.col("grp"), F.col("key").alias("whole"))
    sizes = named.groupBy("grp").agg(F.count("*").alias("rows"))
    if isinstance(quota, DataFrame):
        sizes = sizes.join(quota.select(F.col("grp").alias("g"), "quota"), F.col("grp").eqNullSafe(F.col("g"))).drop("g")
    else:
        sizes = sizes.withColumn("quota", quota)
    sizes = _stored(sizes.withColumn("quota", F.greatest("quota", F.lit(0)).cast("long")).where("quota <= rows"), "sizes")
    zero = F.lit(0).cast("long")
    done = [sizes.where("quota = 0").select("grp", "rows", "quota", F.lit("").alias("key"), zero.alias("take"), zero.alias("ties"))]
    wanted, few = sizes.where("quota > 0"), F.col("rows") <= LAST_ROUND_ROWS
    smallest, largest = wanted.agg(F.min("rows"), F.max("rows")).first()
    heads = named.select("grp", F.conv(F.substring("whole", 1, HEAD_DIGITS), 16, 10).cast("long").alias("head"))
    levels = []
    if smallest is not None:
        large = wanted.where(~few).select(F.col("grp").alias("og"))
        in_large = F.col("grp").eqNullSafe(F.col("og"))
        if smallest <= LAST_ROUND_ROWS:
            rows = heads if largest <= LAST_ROUND_ROWS else heads.join(large, in_large, "left_anti")
            levels.append(_stored(_ranked(rows, wanted.where(few)), "cuts"))
        if largest > LAST_ROUND_ROWS:
            rows = heads if smallest > LAST_ROUND_ROWS else heads.join(large, in_large, "left_semi")
            levels += _narrowed(rows, wanted.where(~few))
    done += [level.where(~F.col("open")).select(*CUT_COLUMNS) for level in levels]
    among = [level.where("open AND NOT more").select(
        F.col("grp").alias("og"), "rows", "quota", F.expr("substring(key, 1, digits)").alias("under"), F.col("take").alias("need")) for level in levels]
    if among:
        state = reduce(DataFrame.unionByName, among)
        if not state.isEmpty():
            done.append(_stored(_counted(named, state), "cuts"))
    return reduce(DataFrame.unionByName, done)


def _hexadecimal(number: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.conv(number.cast("string"), 10, 16)), digits, "0")


def _ranked(heads: DataFrame, wanted: DataFrame) -> DataFrame:
    """Cuts of groups of few rows. The sizes of a group travel as a row before its keys, so one shuffle does."""
    order = Window.partitionBy("grp").orderBy("head")
    none = F.lit(None).cast("long")
    both = heads.select("grp", "head", none.alias("rows"), none.alias("quota")).unionAll(
        wanted.select("grp", F.lit(-1).cast("long"), "rows", "quota"))
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.select(
        "grp", "head", F.first("rows").over(first).alias("rows"), F.first("quota").over(first).alias("quota"),
        (F.row_number().over(order) - 1).alias("place"), (F.rank().over(order) - 2).alias("before"), F.lead("head").over(order).alias("next"))
    take = F.col("quota") - F.col("before")
    return placed.where("place = quota AND head >= 0").select(
        "grp", "rows", "quota", F.rpad(_hexadecimal(F.col("head"), HEAD_DIGITS), KEY_DIGITS, "f").alias("key"), take.alias("take"),
        take.alias("ties"), F.coalesce(F.col("next") == F.col("head"), F.lit(False)).alias("open"), F.lit(HEAD_DIGITS).alias("digits"),
        F.lit(False).alias("more"))


def _narrowed(heads: DataFrame, wanted: DataFrame) -> list[DataFrame]:
    """Cuts of large groups, a table a round. Those that are open and need not go on have few rows left, or equal heads."""
    state, levels, digits = wanted.withColumn("need", F.col("quota")), [], min(HEX_DIGITS_PER_LEVEL, HEAD_DIGITS)
    order = Window.partitionBy("g").orderBy("prefix")
    while True:
        prefix = F.shiftright("head", 4 * (HEAD_DIGITS - digits))
        counted = heads.groupBy(F.col("grp").alias("g"), prefix.alias("prefix")).agg(
            F.count("*").alias("n"), F.min("head").alias("low"), F.max("head").alias("high"))
        level = counted.withColumn("before", F.sum("n").over(order) - F.col("n")).join(state, F.col("g").eqNullSafe(F.col("grp")))
        single, unfinished = F.col("low") == F.col("high"), F.col("need") < F.col("before") + F.col("n")
        key = F.when(single, _hexadecimal(F.col("low"), HEAD_DIGITS)).otherwise(_hexadecimal(F.col("prefix"), digits))
        level = _stored(level.where((F.col("before") < F.col("need")) & (F.col("before") + F.col("n") >= F.col("need"))).select(
            "grp", "rows", "quota", F.rpad(key, KEY_DIGITS, "f").alias("key"), (F.col("need") - F.col("before")).alias("take"),
            F.col("n").alias("ties"), unfinished.alias("open"), F.when(single, HEAD_DIGITS).otherwise(digits).alias("digits"),
            (unfinished & ~single & (F.col("n") > LAST_ROUND_ROWS) & F.lit(digits < HEAD_DIGITS)).alias("more"), "prefix"), "cuts")
        levels.append(level)
        going = level.where("more")
        if going.isEmpty():
            return levels
        under = going.select(F.col("grp").alias("og"), F.col("prefix").alias("under"))
        heads = _stored(heads.join(under, F.col("grp").eqNullSafe(F.col("og")) & (prefix == F.col("under"))).select("grp", "head"), "narrowed")
        state = going.select("grp", "rows", "quota", F.col("take").alias("need"))
        digits = min(digits + HEX_DIGITS_PER_LEVEL, HEAD_DIGITS)


def _counted(named: DataFrame, state: DataFrame) -> DataFrame:
    """Cuts by whole keys, of the rows under the open prefix of their group."""
    rows = named.join(state, F.col("grp").eqNullSafe(F.col("og")) & F.col("whole").startswith(F.col("under")))
    counted = rows.groupBy("grp", "rows", "quota", "need", "whole").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("whole")) - F.col("n")
    return counted.withColumn("before", before).where("before < need AND before + n >= need").select(
        "grp", "rows", "quota", F.col("whole").alias("key"), (F.col("need") - F.col("before")).alias("take"), F.col("n").alias("ties"))


def global_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """Zero-based position in the total order of unique rows, computed on all executors.

    A range-partitioned sort numbers rows inside each partition; the partition offsets (one row
    per partition) are added afterwards. The numbered rows are checkpointed in between, because a
    re-run of the sort could choose other range bounds.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = (
        df.orderBy(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id())
        .checkpoint()
    )
    parts = numbered.groupBy("__part").agg(F.min("__pos").alias("__first"), F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (
        numbered.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__pos") - F.col("__first"))
        .drop("__part", "__pos", "__first", "__before")
    )
