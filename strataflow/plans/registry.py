"""Decorator that collects queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with DuckDB SQL for its rows where there is any."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query twice: {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """df with its doubles rounded, so that the order of sums doesn't show."""
    from pyspark.sql import functions as F

    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])
