"""Calendar functions: date keys, quarter ends, seasons, US federal business days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Months in which annual reports, and quarterly earnings, come out.
ANNUAL_MONTHS = (1, 2, 3)
EARNINGS_MONTHS = (1, 2, 3, 4, 5, 7, 8, 10, 11)


def date_sk(c: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def last_quarter_end(c: Column) -> Column:
    """The last day of the quarter before the one that the date is in."""
    return F.date_sub(F.trunc(c, "quarter"), 1)


def is_annual_season(c: Column) -> Column:
    return F.month(c).isin(*ANNUAL_MONTHS)


def is_earnings_season(c: Column) -> Column:
    return F.month(c).isin(*EARNINGS_MONTHS)


def _nth(year: int, month: int, weekday: int, n: int) -> dt.date:
    first = dt.date(year, month, 1)
    return first + dt.timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))


def federal_holidays(year: int) -> list[dt.date]:
    """Observed US federal holidays of a year, from their rules."""
    fixed = [dt.date(year, 1, 1), dt.date(year, 7, 4), dt.date(year, 11, 11), dt.date(year, 12, 25)]
    if year >= 2021:
        fixed.append(dt.date(year, 6, 19))
    observed = [d - dt.timedelta(1) if d.weekday() == 5 else d + dt.timedelta(1) if d.weekday() == 6 else d for d in fixed]
    memorial = max(dt.date(year, 5, d) for d in range(25, 32) if dt.date(year, 5, d).weekday() == 0)
    return sorted([*observed, _nth(year, 1, 0, 3), _nth(year, 2, 0, 3), memorial, _nth(year, 9, 0, 1), _nth(year, 10, 0, 2), _nth(year, 11, 3, 4)])


def business_days(spark: SparkSession, first: int = 1990, last: int = 2030) -> DataFrame:
    """(date, next_business_day) of every day of the years: weekends and federal holidays are skipped."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{first}-01-01', DATE'{last}-12-31')) AS date")
    off = spark.createDataFrame([(d,) for y in range(first, last + 2) for d in federal_holidays(y)], "off date")
    ahead = days.select("date", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("n")).select("date", F.date_add("date", F.col("n")).alias("day"))
    open_days = ahead.where(~F.dayofweek("day").isin(1, 7)).join(F.broadcast(off), F.col("day") == F.col("off"), "left_anti")
    return open_days.groupBy("date").agg(F.min("day").alias("next_business_day"))
