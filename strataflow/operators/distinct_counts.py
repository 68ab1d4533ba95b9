"""Distinct tickers by dataset and day as bitmaps that merge: any range of days is counted without the manifest.

Tickers are numbered once, in a versioned table that several writers can add to. Each batch of manifest rows appends blocks of 4 KB for
the days that it has; blocks of a place are read as one, so a batch that is added twice changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import exists, update
from .upsert import allocate_sk

_BLOCK = 8 * 4096


def number_tickers(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """(ticker, ticker_no) of all tickers so far, those of rows among them; a ticker's number never changes."""
    fresh = rows.where("ticker <> ''").select("ticker").distinct()

    def change(old: DataFrame | None, noted: dict) -> tuple[DataFrame, dict] | None:
        known = old if old is not None else spark.createDataFrame([], "ticker string, ticker_no long")
        if old is not None and fresh.join(known, "ticker", "left_anti").isEmpty():
            return None
        return allocate_sk(known, fresh, ["ticker"], "ticker_no"), noted

    return update(spark, path, change)


def add_rows(rows: DataFrame, numbers: DataFrame, path: str, day: Column) -> None:
    """Appends the blocks of a batch of manifest rows (dataset, ticker), by month of `day`."""
    known = rows.where("ticker <> ''").select("dataset", day.alias("day"), "ticker").distinct().join(numbers, "ticker")
    at = F.col("ticker_no").cast("bigint")
    blocks = known.groupBy("dataset", "day", F.expr(f"CAST(ticker_no div {_BLOCK} AS INT)").alias("block")).agg(F.bitmap_construct_agg(at % _BLOCK).alias("bits"))
    blocks.withColumn("month", F.date_format("day", "yyyy-MM")).write.mode("append").partitionBy("month").parquet(path)


def distinct_tickers(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None, by: dict[str, Column] | None = None) -> DataFrame:
    """Per value of `by` (the dataset, if not given): n_tickers from the first to the last day; `by` may use dataset and day."""
    blocks = spark.read.schema("dataset string, day date, block int, bits binary, month string").parquet(path) if exists(spark, path) else spark.createDataFrame([], "dataset string, day date, block int, bits binary, month string")
    if first is not None:
        blocks = blocks.where((F.col("month") >= first.strftime("%Y-%m")) & (F.col("day") >= F.lit(first)))
    if last is not None:
        blocks = blocks.where((F.col("month") <= last.strftime("%Y-%m")) & (F.col("day") <= F.lit(last)))
    keys = by or {"dataset": F.col("dataset")}
    merged = blocks.groupBy(*[c.alias(n) for n, c in keys.items()], "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*keys).agg(F.sum("n").alias("n_tickers"))


def universe_share(counts: DataFrame, universe_size: int) -> DataFrame:
    """Counts with the share of the universe's tickers, in percent."""
    return counts.select(*[c for c in counts.columns if c != "n_tickers"], F.round(F.col("n_tickers") * 100.0 / universe_size, 2).alias("universe_pct"))
