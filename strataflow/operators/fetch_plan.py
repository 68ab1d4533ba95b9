"""What to fetch next: datasets that are due, and windows of history still to be filled."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .coverage import BASELINE, IDENTITY


def due(contracts: DataFrame, marks: DataFrame, today: dt.date) -> DataFrame:
    """Contracts to fetch today, with the window's from_date and to_date.

    contracts: the identity and min_age_days; marks: bulk_watermarks. Skipped if ingested today, or within
    min_age_days; the window begins after the last covered date, at the baseline if there is none, and must
    not be empty.
    """
    day = F.lit(today)
    side = marks.select(*IDENTITY, F.col("last_ingested_at").cast("date").alias("__seen"), F.col("last_to_date").alias("__to"))
    rows = contracts.join(side, IDENTITY, "left")
    age = F.datediff(day, "__seen")
    ready = F.col("__seen").isNull() | ((F.col("__seen") < day) & (age > F.col("min_age_days")))
    start = F.coalesce(F.date_add("__to", 1), F.lit(BASELINE))
    return rows.where(ready).select(*IDENTITY, start.alias("from_date"), day.alias("to_date")).where("from_date <= to_date")


def backward_windows(contracts: DataFrame, marks: DataFrame, floors: DataFrame, days: int) -> DataFrame:
    """Next window of older history per identity: it ends before the floor, or else before the earliest covered date.

    contracts: identity and uses_date_range; marks: point_watermarks; floors: identity and floor_date. Identities
    that reach the baseline, have nothing yet, or take no dates, have no window.
    """
    side = marks.select(*IDENTITY, F.col("earliest_bronze_from").alias("__first"))
    rows = contracts.where("uses_date_range").join(side, IDENTITY).join(floors.select(*IDENTITY, "floor_date"), IDENTITY, "left")
    end = F.date_sub(F.least("floor_date", "__first"), 1)
    return rows.withColumn("to_date", end).where(F.col("to_date") >= F.lit(BASELINE)).select(*IDENTITY, F.greatest(F.date_sub("to_date", days - 1), F.lit(BASELINE)).alias("from_date"), "to_date")


def next_floors(windows: DataFrame, results: DataFrame) -> DataFrame:
    """Floors after the windows were fetched: results (identity, n_rows, earliest). An empty answer, or one that
    reaches no further back, ends an identity at the baseline."""
    rows = windows.join(results, IDENTITY, "left")
    got = F.coalesce("n_rows", F.lit(0)) > 0
    floor = F.when(got & (F.col("earliest") <= F.col("to_date")), F.greatest("earliest", F.lit(BASELINE))).otherwise(F.lit(BASELINE))
    return rows.select(*IDENTITY, floor.alias("floor_date"))
