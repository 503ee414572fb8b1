"""Schema contract for feature building: names and types on the driver, values in one job."""

from __future__ import annotations

import logging
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.errors import MissingRequiredColumnError, SchemaValidationError
from riskframe.functions.columns import flag, is_infinite

LOGGER = logging.getLogger(__name__)

# --- fixed values: minimum columns and plausible ranges (inclusive) ----------------------
REQUIRED_COLUMNS = ("bmi", "glucose_fasting")
REQUIRED_ALTERNATIVES = (("Age", "age"),)
NUMERIC_RANGES = {
    "Age": (0, 120),
    "age": (0, 120),
    "bmi": (10, 80),
    "glucose_fasting": (40, 600),
    "hba1c": (2, 25),
    "systolic_bp": (50, 300),
    "diastolic_bp": (30, 200),
}


def duplicate_column_names(df: DataFrame) -> list[str]:
    return sorted(name for name, times in Counter(df.columns).items() if times > 1)


def range_checks(df: DataFrame) -> DataFrame:
    """Long table ``(column_name, minimum, maximum, infinite_values, out_of_range)``.

    One pass: every ranged column contributes two conditional sums to a single aggregate, whose
    one row is then unpivoted.
    """
    ranged = [name for name in NUMERIC_RANGES if name in df.columns]
    if not ranged:
        raise SchemaValidationError("no ranged column present")
    aggregates = []
    for name in ranged:
        low, high = NUMERIC_RANGES[name]
        value = F.when(~F.isnan(F.col(name).cast("double")), F.col(name))
        aggregates.append(F.coalesce(F.sum(flag(is_infinite(value))), F.lit(0)).alias(f"{name}__inf"))
        aggregates.append(F.coalesce(F.sum(flag(~value.between(low, high))), F.lit(0)).alias(f"{name}__out"))
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(float(NUMERIC_RANGES[name][0])).alias("minimum"),
                F.lit(float(NUMERIC_RANGES[name][1])).alias("maximum"),
                F.col(f"{name}__inf").alias("infinite_values"),
                F.col(f"{name}__out").alias("out_of_range"),
            )
            for name in ranged
        ]
    )
    return df.agg(*aggregates).select(F.inline(entries))


class DataSchemaValidator:
    """Reject unusable inputs before features are built."""

    def __init__(self, strict_ranges: bool = False) -> None:
        self.strict_ranges = strict_ranges

    def validate_column_names(self, df: DataFrame) -> None:
        if duplicate_column_names(df):
            raise SchemaValidationError(f"names given twice or more, duplicate: {', '.join(duplicate_column_names(df))}")

    def validate_required_columns(self, df: DataFrame) -> None:
        # a single column is a choice of one
        choices = [{name} for name in REQUIRED_COLUMNS] + [set(options) for options in REQUIRED_ALTERNATIVES]
        unmet = ["/".join(sorted(options)) for options in choices if options.isdisjoint(df.columns)]
        if unmet:
            raise MissingRequiredColumnError(unmet)

    def validate_numeric_columns(self, df: DataFrame) -> None:
        ranged = [f for f in df.schema.fields if f.name in NUMERIC_RANGES]
        # booleans count as numbers for this check
        text = [f.name for f in ranged if not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
        if text:
            raise SchemaValidationError(f"not numeric: {', '.join(text)}")
        if df.isStreaming or not ranged:
            return
        found = range_checks(df).collect()
        endless = [f"{r.column_name} ({r.infinite_values})" for r in found if r.infinite_values]
        if endless:
            raise SchemaValidationError(f"infinite values in {', '.join(endless)}")
        outside = [f"{r.column_name} ({r.out_of_range} rows, plausible is {r.minimum:g} to {r.maximum:g})" for r in found if r.out_of_range]
        if outside and self.strict_ranges:
            raise SchemaValidationError(f"values outside their range: {', '.join(outside)}")
        for each in outside:
            LOGGER.warning("implausible values: %s", each)

    def validate(self, df: DataFrame) -> None:
        if not isinstance(df, DataFrame):
            raise SchemaValidationError(f"a DataFrame is needed, not {type(df).__name__}")
        for check in (self.validate_column_names, self.validate_required_columns, self.validate_numeric_columns):
            check(df)
