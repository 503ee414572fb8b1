"""Registration of the driver queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Integers as BIGINT and fractions rounded, as the oracle texts do."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column.cast("double"), digits) + F.lit(0.0)
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("long")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def r(expression: str, digits: int = 6) -> str:
    """Rounded double in oracle SQL (adding zero removes the sign of a negative zero)."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0.0)"
