"""Static dimensions: the calendar and small vocabularies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_sk

#: Vocabularies of the star schema.
INSTRUMENT_TYPES = ("stock", "etf", "index", "crypto", "forex", "commodity", "fund", "trust")
SECTORS = ("Basic Materials", "Communication Services", "Consumer Cyclical", "Consumer Defensive", "Energy", "Financial Services", "Healthcare", "Industrials", "Real Estate", "Technology", "Utilities", "Other")


def calendar(spark: SparkSession, first: dt.date = dt.date(1990, 1, 1), last: dt.date = dt.date(2030, 12, 31)) -> DataFrame:
    """One row per day. Weeks are ISO weeks; day_of_week counts from Sunday, 0."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS date")
    weekday = (F.dayofweek("date") - 1).alias("day_of_week")
    return days.select(
        date_sk(F.col("date")).alias("date_sk"), "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"), F.weekofyear("date").alias("week"),
        F.dayofmonth("date").alias("day"), weekday, F.date_format("date", "EEEE").alias("day_name"), F.date_format("date", "MMMM").alias("month_name"),
        F.dayofweek("date").isin(1, 7).alias("is_weekend"), F.lit(False).alias("is_us_market_day"),
    )


def vocabulary(spark: SparkSession, names: tuple[str, ...], sk: str, name: str) -> DataFrame:
    """Numbered rows of a fixed vocabulary."""
    return spark.createDataFrame(list(enumerate(names, 1)), f"{sk} int, {name} string").withColumn(sk, F.col(sk).cast("smallint"))


def seed(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """target with the rows whose key it lacks; seeding again changes nothing."""
    return target.unionByName(rows.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def table_sizes(tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table, n_rows) of each, -1 for one that isn't there; one job for all."""
    there = [df.select(F.lit(n).alias("table")).groupBy("table").agg(F.count(F.lit(1)).alias("n_rows")) for n, df in tables.items() if df is not None]
    spark = SparkSession.active()
    names = spark.createDataFrame([(n, df is None) for n, df in tables.items()], "table string, absent boolean")
    if not there:
        return names.select("table", F.lit(-1).cast("bigint").alias("n_rows"))
    counts = there[0]
    for x in there[1:]:
        counts = counts.unionByName(x)
    return names.join(F.broadcast(counts), "table", "left").select("table", F.when(F.col("absent"), F.lit(-1)).otherwise(F.coalesce("n_rows", F.lit(0))).cast("bigint").alias("n_rows"))


def read_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None
