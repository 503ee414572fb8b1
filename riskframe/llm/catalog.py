"""Registration of the queries of this subpackage."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Keep a query and, where SQL can say it, its DuckDB text."""

    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep
