"""Column clean-up, category recodes, leakage removal, duplicate removal."""

from __future__ import annotations

from collections import Counter
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import finite_or_null, recode
from riskframe.operators.duplicates import drop_duplicate_rows

# --- fixed values: category recodes and leakage columns ---------------------------------
CATEGORY_RECODES = {
    "gender": {"Other": "Unknown"},
    "employment_status": {"Retired": "Inactive", "Unemployed": "Inactive"},
    "smoking_status": {"Former": "Ex-Smoker"},
}
LEAKAGE_COLUMNS = ("diabetes_stage", "diabetes_risk_score", "diagnosed_diabetes")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names; two names must not become one."""
    stripped = [name.strip() for name in df.columns]
    repeated = [name for name, times in Counter(stripped).items() if times > 1]
    if repeated:
        raise ValueError(f"column normalization created duplicates: {repeated}")
    return df if stripped == df.columns else df.toDF(*stripped)


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def infinities_to_missing(df: DataFrame) -> DataFrame:
    """Infinite and NaN values of floating columns become NULL."""
    names = floating_columns(df)
    return df.withColumns({n: finite_or_null(F.col(f"`{n}`")) for n in names}) if names else df


def clean_categorical_variables(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Recode the known category spellings of the text columns that exist; coded columns stay as they are."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    present = {
        name: recode(F.col(name), mapping)
        for name, mapping in CATEGORY_RECODES.items()
        if name in text and name not in skip
    }
    return df.withColumns(present) if present else df


def drop_leakage_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns that reveal the outcome, unless they are protected."""
    return df.drop(*[name for name in LEAKAGE_COLUMNS if name in df.columns and name not in keep])


def integers_to_double(df: DataFrame) -> DataFrame:
    """Widen integral columns so that a missing value can appear at scoring time."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    return df.withColumns({n: F.col(f"`{n}`").cast("double") for n in names}) if names else df


def drop_incomplete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows in which none of the columns is missing."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def auto_detect_column_types(
    df: DataFrame,
    exclude: Sequence[str] | None = None,
    target: str | None = None,
    id_columns: Sequence[str] | None = None,
) -> tuple[list[str], list[str]]:
    """Split feature columns into numeric and categorical, input order kept, booleans categorical."""
    skipped = set(exclude or ()) | set(id_columns or ()) | ({target} if target else set())
    numeric, categorical = [], []
    for field in df.schema.fields:
        if field.name not in skipped:
            (numeric if isinstance(field.dataType, T.NumericType) else categorical).append(field.name)
    return numeric, categorical


def preprocess_dataset(df: DataFrame, *, drop_duplicates: bool = True, hash_first: bool = False) -> DataFrame:
    """Normalize names, fold infinities into NULL, drop duplicate rows, recode categories.

    Lazy by default. ``hash_first=True`` looks for duplicates by row hash at once, which spares
    large tables with few duplicates the shuffle of whole rows.
    """
    result = infinities_to_missing(normalize_column_names(df))
    if drop_duplicates:
        result = drop_duplicate_rows(result) if hash_first else result.dropDuplicates()
    return clean_categorical_variables(result)


class DatasetPreprocessor:
    """Object form of :func:`preprocess_dataset`."""

    def __init__(self, *, drop_duplicates: bool = True) -> None:
        self.drop_duplicates = drop_duplicates

    def transform(self, df: DataFrame) -> DataFrame:
        return preprocess_dataset(df, drop_duplicates=self.drop_duplicates)
