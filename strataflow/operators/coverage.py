"""Coverage index: what has been ingested for each dataset identity, its summaries and rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTITY = ["domain", "source", "dataset", "discriminator", "ticker"]
BASELINE = dt.date(1990, 1, 1)


def _share(part: Column, whole: Column, scale: float = 1.0, digits: int = 4) -> Column:
    return F.round(F.try_divide(part.cast("double") * scale, whole.cast("double")), digits)


def coverage_base(manifest: DataFrame) -> DataFrame:
    """One row per identity of the manifest, null discriminators and tickers as blank."""
    keyed = manifest.withColumns({c: F.coalesce(c, F.lit("")) for c in ("discriminator", "ticker")})
    return keyed.groupBy(*IDENTITY).agg(
        F.min("bronze_from_date").alias("min_date"), F.max("bronze_to_date").alias("max_date"), F.count(F.lit(1)).alias("total_files"),
        F.count_if("bronze_can_promote").alias("promotable_files"), F.count_distinct("run_id").alias("ingestion_runs"),
        F.coalesce(F.sum("silver_rows_created"), F.lit(0)).alias("silver_rows_created"), F.coalesce(F.sum("silver_rows_failed"), F.lit(0)).alias("silver_rows_failed"),
        F.count_if(F.col("bronze_error").isNotNull()).alias("error_count"), F.max("bronze_injest_start_time").alias("last_ingested_at"), F.max("run_id").alias("last_run_id"),
    )


def coverage_index(base: DataFrame, meta: DataFrame, today: dt.date, universe_from: dt.date) -> DataFrame:
    """base with ratios or ages. meta (domain, source, dataset, is_timeseries, ticker_scope, is_historical); datasets
    that it lacks count as historical series per ticker."""
    known = base.join(meta, ["domain", "source", "dataset"], "left").withColumns({
        "is_timeseries": F.coalesce("is_timeseries", F.lit(True)), "ticker_scope": F.coalesce("ticker_scope", F.lit("per_ticker")), "is_historical": F.coalesce("is_historical", F.lit(True)),
    })
    day, past = F.lit(today), F.col("is_historical")
    span = F.greatest(F.datediff("max_date", "min_date"), F.lit(0)).cast("double")
    ratio = F.round(span / float(max((today - BASELINE).days, 1)), 4)
    seen = F.coalesce("max_date", F.col("last_ingested_at").cast("date"))
    return known.withColumns({
        "coverage_ratio": F.when(past, ratio), "expected_start_date": F.when(past, F.lit(BASELINE)).otherwise(F.lit(universe_from)), "expected_end_date": day,
        "error_rate": _share(F.col("error_count"), F.col("total_files")), "snapshot_count": F.when(past, F.lit(0)).otherwise(F.col("total_files")).cast("bigint"),
        "last_snapshot_date": F.when(~past, seen), "age_days": F.when(~past, F.datediff(day, seen)),
    })


def summary(index: DataFrame) -> DataFrame:
    """Per dataset: tickers, mean coverage and error rate, last ingestion."""
    return index.groupBy("domain", "source", "dataset").agg(
        F.count_distinct("ticker").alias("tickers_covered"), F.round(F.avg("coverage_ratio"), 4).alias("avg_coverage_ratio"),
        F.round(F.avg("error_rate"), 4).alias("avg_error_rate"), F.max("last_ingested_at").alias("last_ingested_at"),
    )


def matrix(index: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """Per dataset: share updated in the last days, median history in calendar years, age of the oldest end."""
    fresh = F.count_if(F.col("last_ingested_at") > F.lit(now - dt.timedelta(days=days)))
    return index.groupBy("dataset").agg(
        F.count_distinct("ticker").alias("tickers_covered"), F.avg("coverage_ratio").alias("avg_coverage_ratio"), F.try_divide(fresh, F.count(F.lit(1))).alias("pct_updated_7d"),
        F.median(F.year("max_date") - F.year("min_date")).alias("median_history_years"), F.max(F.datediff(F.lit(now.date()), "max_date")).alias("oldest_max_date_age"),
    )


def scope_summary(index: DataFrame, per_ticker: bool, historical: bool) -> DataFrame:
    """Summary of one of the four kinds of dataset: per ticker or global, historical or snapshot."""
    rows = index.where((F.col("ticker_scope") == ("per_ticker" if per_ticker else "global")) & (F.col("is_historical") == F.lit(historical)))
    keys = ["domain", "source", "dataset"] + ([] if per_ticker else ["discriminator"])
    out = [F.count_distinct(F.when(F.col("ticker") != "", F.col("ticker"))).alias("tickers_covered")] if per_ticker else [F.sum("total_files").alias("total_files")]
    if historical:
        out += [F.round(F.avg("coverage_ratio"), 4).alias("avg_coverage_ratio"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.min("expected_start_date").alias("expected_start_date"), F.max("expected_end_date").alias("expected_end_date")]
    else:
        out += [F.round(F.avg("age_days"), 1).alias("avg_age_days"), F.max("last_snapshot_date").alias("last_snapshot_date")]
    return rows.groupBy(*keys).agg(*out, F.round(F.avg("error_rate"), 4).alias("avg_error_rate"), F.max("last_ingested_at").alias("last_ingested_at"))


def weakest_first(df: DataFrame, by: str = "avg_coverage_ratio", *ties: str) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(by), *ties)


def by_dataset(index: DataFrame, dataset: str) -> DataFrame:
    names = ("ticker", "discriminator", "min_date", "max_date", "coverage_ratio", "total_files", "error_count", "error_rate", "last_ingested_at", "is_timeseries")
    return weakest_first(index.where(F.col("dataset") == dataset).select(*names), "coverage_ratio", "ticker", "discriminator")


def by_ticker(index: DataFrame, ticker: str) -> DataFrame:
    names = ("dataset", "discriminator", "is_timeseries", "min_date", "max_date", "coverage_ratio", "total_files", "error_count", "error_rate", "last_ingested_at", "age_days", "last_snapshot_date")
    return weakest_first(index.where(F.col("ticker") == ticker).select(*names), "coverage_ratio", "dataset", "discriminator")


def stale_snapshots(index: DataFrame, min_age_days: int) -> DataFrame:
    rows = index.where(~F.col("is_timeseries") & (F.col("age_days") >= min_age_days))
    return rows.select("dataset", "discriminator", "ticker", "last_snapshot_date", "age_days").orderBy(F.desc_nulls_last("age_days"), "dataset", "discriminator", "ticker")


def distinct_values(index: DataFrame, column: str) -> DataFrame:
    """Distinct values but blanks, in order."""
    return index.select(column).where(F.col(column) != "").distinct().orderBy(column)


def completeness(index: DataFrame, n_datasets: int) -> DataFrame:
    """Per ticker: share of the datasets that it has, mean coverage, errors."""
    return index.where("ticker <> ''").groupBy("ticker").agg(
        F.round(F.count_distinct("dataset") / n_datasets, 4).alias("completeness"), F.round(F.avg("coverage_ratio"), 4).alias("mean_coverage"),
        F.sum("error_count").alias("errors"), _share(F.sum("error_count"), F.sum("total_files"), 100.0, 2).alias("error_pct"),
    )


def universe_share(index: DataFrame, universe_size: int) -> DataFrame:
    """Per dataset: share of the universe's tickers, in percent."""
    return index.where("ticker <> ''").groupBy("dataset").agg(F.round(F.count_distinct("ticker") * 100.0 / universe_size, 2).alias("universe_pct"))


def presence(index: DataFrame, dataset: str, ends: int = 50) -> DataFrame:
    """(ticker, year) in which a dataset has data; of more than two times `ends` tickers, the weakest and strongest."""
    rows = index.where((F.col("dataset") == dataset) & (F.col("ticker") != "") & F.col("min_date").isNotNull() & F.col("max_date").isNotNull())
    tickers = rows.groupBy("ticker").agg(F.max("coverage_ratio").alias("r"))
    weak = tickers.orderBy(F.asc_nulls_last("r"), "ticker").limit(ends).select("ticker")
    strong = tickers.orderBy(F.desc_nulls_last("r"), "ticker").limit(ends).select("ticker")
    chosen = weak.union(strong).distinct()
    return rows.join(chosen, "ticker", "left_semi").select("ticker", F.explode(F.sequence(F.year("min_date"), F.year("max_date"))).alias("year")).distinct()


def presence_matrix(index: DataFrame, dataset: str, first: int, last: int, ends: int = 50) -> DataFrame:
    """presence() with a column for each year, 1 or 0."""
    return presence(index, dataset, ends).groupBy("ticker").pivot("year", list(range(first, last + 1))).agg(F.lit(1)).na.fill(0)


def ratio_histogram(index: DataFrame, bins: int = 20) -> DataFrame:
    """(bin, n) of coverage ratios from 0 to 1; 1 falls into the last bin."""
    at = F.least(F.floor(F.col("coverage_ratio") * bins), F.lit(bins - 1)).cast("int")
    return index.where("coverage_ratio IS NOT NULL").groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
