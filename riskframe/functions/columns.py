"""Column primitives with data-frame-library missing-value rules.

All of them are plain Catalyst expressions: they stay inside whole-stage codegen and work
unchanged on streaming DataFrames. NULL is the only missing value; :func:`nan_to_null` and
:func:`finite_or_null` bring NaN and infinities into that form.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bin_column(
    value: Column, edges: Sequence[float], labels: Sequence[str], *, right: bool
) -> Column:
    """Label the interval a value falls in; NULL outside every interval.

    ``right=True`` means ``(a, b]`` and excludes the first edge, ``right=False`` means
    ``[a, b)``, so an infinite value itself is outside even when the last edge is infinite.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("labels must have one entry fewer than edges")
    expr: Column | None = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = (
            (value > F.lit(low)) & (value <= F.lit(high))
            if right
            else (value >= F.lit(low)) & (value < F.lit(high))
        )
        expr = F.when(inside, F.lit(label)) if expr is None else expr.when(inside, F.lit(label))
    return expr


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; a missing value stays missing (``least``/``greatest`` would drop it)."""
    expr = value
    if high is not None:
        expr = F.when(expr > F.lit(high), F.lit(high)).otherwise(expr)
    if low is not None:
        expr = F.when(expr < F.lit(low), F.lit(low)).otherwise(expr)
    return expr


def is_true(predicate: Column) -> Column:
    """Two-valued predicate: a comparison with a missing value is false."""
    return F.coalesce(predicate, F.lit(False))


def flag(predicate: Column) -> Column:
    """0/1 from a predicate, never missing."""
    return is_true(predicate).cast("long")


def count_flags(predicates: Iterable[Column], weight: int = 1) -> Column:
    """Number of predicates that hold, times ``weight``."""
    total = reduce(lambda left, right: left + right, [flag(p) for p in predicates])
    return total if weight == 1 else total * F.lit(weight)


def select_label(
    conditions: Sequence[Column], labels: Sequence[str], default: str
) -> Column:
    """First condition that is true wins; missing comparisons fall through to ``default``."""
    expr = F.when(conditions[0], F.lit(labels[0]))
    for condition, label in zip(conditions[1:], labels[1:]):
        expr = expr.when(condition, F.lit(label))
    return expr.otherwise(F.lit(default))


def recode(value: Column, mapping: Mapping[str, str]) -> Column:
    """Exact-match replacement; everything else is left as it is."""
    expr: Column | None = None
    for old, new in mapping.items():
        expr = F.when(value == old, F.lit(new)) if expr is None else expr.when(value == old, F.lit(new))
    return value if expr is None else expr.otherwise(value)


def row_sum(values: Sequence[Column]) -> Column:
    """Sum across columns, missing counted as zero."""
    return reduce(lambda left, right: left + right, [F.coalesce(v, F.lit(0)) for v in values])


def guarded_log(value: Column) -> Column:
    """Natural logarithm where the argument is positive, NULL elsewhere."""
    return F.when(value > 0, F.ln(value))


def nan_to_null(value: Column) -> Column:
    """Fold NaN into NULL."""
    return F.when(~F.isnan(value), value)


def finite_or_null(value: Column) -> Column:
    """Fold NaN and both infinities into NULL."""
    return F.when(~(F.isnan(value) | (F.abs(value) == F.lit(math.inf))), value)


def is_infinite(value: Column) -> Column:
    """True for plus or minus infinity."""
    return F.abs(value) == F.lit(math.inf)


def to_number(value: Column) -> Column:
    """Lenient number: unparseable text, NaN and NULL all become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def bin_index(value: Column, inner_edges: Sequence[float], *, closed: bool = True) -> Column:
    """Zero-based bin of a non-missing value: how many inner edges are ``<=`` it.

    ``closed=False`` counts the edges strictly below the value instead.

    A balanced CASE tree, so a value costs ``log2(edges)`` comparisons in generated code.
    """
    if not inner_edges:
        return F.when(value.isNotNull(), F.lit(0))

    def build(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        edge = F.lit(inner_edges[middle])
        left = value < edge if closed else value <= edge
        return F.when(left, build(low, middle)).otherwise(build(middle + 1, high))

    return F.when(value.isNotNull(), build(0, len(inner_edges)))


def has_columns(df: DataFrame, *required: str) -> bool:
    """Whether all columns exist (decided on the driver, no job)."""
    return set(required) <= set(df.columns)
