"""Reusable column expressions and distributed order-statistics helpers."""

from riskframe.functions.columns import (
    bin_column,
    bin_index,
    clip,
    count_flags,
    finite_or_null,
    flag,
    guarded_log,
    has_columns,
    is_infinite,
    is_true,
    nan_to_null,
    recode,
    row_sum,
    safe_ratio,
    select_label,
    to_number,
)

__all__ = [
    "bin_column",
    "bin_index",
    "clip",
    "count_flags",
    "finite_or_null",
    "flag",
    "guarded_log",
    "has_columns",
    "is_infinite",
    "is_true",
    "nan_to_null",
    "recode",
    "row_sum",
    "safe_ratio",
    "select_label",
    "to_number",
]
