"""Reports as long tables: (section, item, metric, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stored
from . import moat as M
from . import ops as O


def long(df: DataFrame, section: str, item: Column) -> DataFrame:
    """Every numeric column of df as rows."""
    numbers = [c for c, t in df.dtypes if t in ("bigint", "int", "double")]
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numbers])
    return df.select(F.lit(section).alias("section"), F.coalesce(item.cast("string"), F.lit("")).alias("item"), F.inline(rows))


def run_report(manifest: DataFrame, universe: DataFrame, run_id: str) -> DataFrame:
    """A run's domains, datasets, promotions and the universe's state."""
    run = manifest.where(F.col("run_id") == run_id)
    parts = [
        long(O.domain_summary(run), "domain", F.col("domain")), long(O.dataset_breakdown(manifest, run_id), "dataset", F.col("dataset")), long(O.silver_promotion(manifest, run_id), "promotion", F.col("dataset")),
        long(O.universe_totals(O.universe_presence(universe, manifest)), "universe", F.lit("")), long(O.universe_datasets(universe, manifest, manifest), "universe_dataset", F.col("dataset")),
    ]
    return reduce(DataFrame.unionByName, parts)


def validation_report(scores: DataFrame, columns: list[str], year: str = "calendar_year") -> DataFrame:
    """Rows by year, the columns' distribution, and how often the wider benchmark was used."""
    scores = stored(scores, "scores")  # read three times
    years = scores.groupBy(year).agg(F.count(F.lit(1)).alias("n_rows"))
    parts = [long(years.withColumn("y", F.col(year).cast("string")).drop(year), "year", F.col("y")), long(M.profile(scores, columns), "profile", F.col("column")), long(M.fallback_rate(scores).withColumn("y", F.col(year).cast("string")).drop(year), "fallback", F.col("y"))]
    return reduce(DataFrame.unionByName, parts)
