"""Incremental coverage: a state for each identity that merges, so that a refresh reads new manifest rows only.

The manifest lies in a folder of batches (``batch=<name>``), which are written once. The state is a versioned table, whose note
holds the batches that it covers: both change in one step, so a batch counts once however often a fold is done or retried.
Rows that change later, as those of promoted files do, come as batches of corrections, see :func:`correction`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import current, exists, names, note, update
from .coverage import IDENTITY

_LEAST, _MOST = ("min_date",), ("max_date", "last_ingested_at", "last_run_id")
_SUMS = ("total_files", "promotable_files", "silver_rows_created", "silver_rows_failed", "error_count")


def partial_state(manifest: DataFrame) -> DataFrame:
    """The state of manifest rows: one row per identity, null discriminators and tickers as blank; run_ids: its runs."""
    keyed = manifest.withColumns({c: F.coalesce(c, F.lit("")) for c in ("discriminator", "ticker")})
    count = lambda c: F.count_if(c).cast("long")
    return keyed.groupBy(*IDENTITY).agg(
        F.min("bronze_from_date").alias("min_date"), F.max("bronze_to_date").alias("max_date"), F.max("bronze_injest_start_time").alias("last_ingested_at"), F.max("run_id").alias("last_run_id"),
        F.count(F.lit(1)).alias("total_files"), count(F.col("bronze_can_promote")).alias("promotable_files"), F.coalesce(F.sum("silver_rows_created"), F.lit(0)).alias("silver_rows_created"),
        F.coalesce(F.sum("silver_rows_failed"), F.lit(0)).alias("silver_rows_failed"), count(F.col("bronze_error").isNotNull()).alias("error_count"), F.collect_set("run_id").alias("run_ids"),
    )


def merged(*states: DataFrame) -> DataFrame:
    """States of disjoint rows as one."""
    rows = reduce(DataFrame.unionByName, states)
    out = [F.min(c).alias(c) for c in _LEAST] + [F.max(c).alias(c) for c in _MOST] + [F.sum(c).alias(c) for c in _SUMS]
    return rows.groupBy(*IDENTITY).agg(*out, F.array_distinct(F.flatten(F.collect_list("run_ids"))).alias("run_ids"))


def correction(before: DataFrame, after: DataFrame) -> DataFrame:
    """The state that turns one of `before` into one of `after` when merged: the same files' rows, of which counts may
    have changed either way, and dates and runs may have been added to."""
    less = partial_state(before).withColumns({c: -F.col(c) for c in _SUMS})
    return merged(less, partial_state(after))


def base_of(state: DataFrame) -> DataFrame:
    """The coverage base, as :func:`.coverage.coverage_base` has it for all rows."""
    return state.select(*IDENTITY, "min_date", "max_date", "total_files", "promotable_files", F.size("run_ids").cast("long").alias("ingestion_runs"), "silver_rows_created", "silver_rows_failed", "error_count", "last_ingested_at", "last_run_id")


def fold(spark: SparkSession, manifest_path: str, state_path: str) -> DataFrame:
    """The state after all batches that are there; reads those that it doesn't cover yet, and no others."""

    def change(old: DataFrame | None, noted: dict) -> tuple[DataFrame, dict] | None:
        done = noted.get("batches", [])
        fresh = [b for b in names(spark, manifest_path) if b.startswith("batch=") and b not in set(done)]
        if old is not None and not fresh:
            return None
        rows = spark.read.option("basePath", manifest_path).parquet(*[f"{manifest_path}/{b}" for b in fresh])
        state = partial_state(rows)
        return (state if old is None else merged(old, state)), {**noted, "batches": [*done, *fresh]}

    return update(spark, state_path, change)


def correct(spark: SparkSession, state_path: str, name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """The state after a named correction, which counts once."""

    def change(old: DataFrame | None, noted: dict) -> tuple[DataFrame, dict] | None:
        if name in noted.get("corrections", []):
            return None
        return merged(old, correction(before, after)), {**noted, "corrections": [*noted.get("corrections", []), name]}

    return update(spark, state_path, change)


def covered(spark: SparkSession, state_path: str) -> list[str]:
    """Batches that the state covers."""
    return note(spark, state_path).get("batches", []) if exists(spark, state_path) else []


def state_at(spark: SparkSession, state_path: str) -> DataFrame:
    return current(spark, state_path)
