"""Manifest queries: watermarks, error and latency reports, run reports, integrity, promotion bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .coverage import IDENTITY
from .upsert import upsert

def _blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _identified(manifest: DataFrame) -> DataFrame:
    return manifest.withColumns({c: _blank(c) for c in ("discriminator", "ticker")})


def _failed() -> Column:
    return F.col("bronze_error").isNotNull()


def error_rates(manifest: DataFrame) -> DataFrame:
    """Per dataset: files, failed files and their share in percent."""
    n, bad = F.count(F.lit(1)), F.count_if(_failed())
    return manifest.groupBy("dataset").agg(n.alias("total_files"), bad.alias("error_count"), F.round(bad * 100.0 / n, 2).alias("error_rate_pct"))


def latency(manifest: DataFrame) -> DataFrame:
    """Per dataset: mean, 95th percentile and largest ingestion time in milliseconds."""
    took = F.expr("timestampdiff(MILLISECOND, bronze_injest_start_time, bronze_injest_end_time)").cast("double")
    rows = manifest.where("bronze_injest_start_time IS NOT NULL AND bronze_injest_end_time IS NOT NULL").withColumn("__ms", took)
    return rows.groupBy("dataset").agg(F.round(F.avg("__ms"), 1).alias("avg_ms"), F.round(F.percentile("__ms", 0.95), 1).alias("p95_ms"), F.round(F.max("__ms"), 1).alias("max_ms"))


def hash_stability(manifest: DataFrame) -> DataFrame:
    """Per dataset: distinct payload hashes against files that have one; 100 % means that nothing ever changed."""
    n, kinds = F.count("bronze_payload_hash"), F.count_distinct("bronze_payload_hash")
    return manifest.where("bronze_payload_hash IS NOT NULL").groupBy("dataset").agg(n.alias("total"), kinds.alias("distinct_hashes"), F.round((1.0 - (kinds - 1) / n) * 100, 2).alias("stability_pct"))


def bulk_watermarks(manifest: DataFrame) -> DataFrame:
    """Per identity: last successful ingestion and last covered date."""
    return _identified(manifest).groupBy(*IDENTITY).agg(F.max(F.when(~_failed(), F.col("bronze_injest_start_time"))).alias("last_ingested_at"), F.max("bronze_to_date").alias("last_to_date"))


def point_watermarks(manifest: DataFrame) -> DataFrame:
    """Per identity: latest and earliest covered dates of both layers and the latest ingestion, in one aggregate."""
    return _identified(manifest).groupBy(*IDENTITY).agg(
        F.max("bronze_to_date").alias("latest_bronze_to"), F.max("bronze_injest_start_time").alias("latest_ingestion"),
        F.max("silver_to_date").alias("latest_silver_to"), F.min("bronze_from_date").alias("earliest_bronze_from"),
    )


def input_watermarks(manifest: DataFrame) -> DataFrame:
    """Identities with their covered range as text: domain/source/dataset/discriminator/ticker:from:to."""
    rows = _identified(manifest).groupBy(*IDENTITY).agg(F.min("silver_from_date").alias("a"), F.max("silver_to_date").alias("b"))
    day = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rows.where("a IS NOT NULL OR b IS NOT NULL").select(F.concat(F.concat_ws("/", *IDENTITY), F.lit(":"), day("a"), F.lit(":"), day("b")).alias("watermark"))


def domain_summary(manifest: DataFrame, run_id: str | None = None) -> DataFrame:
    """Per domain and over all (domain null): files, failures, datasets, tickers, rows. One rollup."""
    rows = manifest if run_id is None else manifest.where(F.col("run_id") == run_id)
    return rows.rollup("domain").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(_failed()).alias("failed"), F.count_distinct("dataset").alias("datasets"),
        F.count_distinct(F.when(_blank("ticker") != "", F.col("ticker"))).alias("tickers"), F.coalesce(F.sum("bronze_rows"), F.lit(0)).alias("rows"),
    )


def dataset_breakdown(manifest: DataFrame, run_id: str) -> DataFrame:
    return manifest.where(F.col("run_id") == run_id).groupBy("domain", "dataset").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~_failed()).alias("passed"), F.count_if(_failed()).alias("failed"), F.coalesce(F.sum("bronze_rows"), F.lit(0)).alias("rows"),
        F.min("bronze_from_date").alias("from_date"), F.max("bronze_to_date").alias("to_date"),
    )


def silver_promotion(manifest: DataFrame, run_id: str) -> DataFrame:
    """Per dataset of a run: files promoted, created and failed rows, promotion errors."""
    return manifest.where((F.col("run_id") == run_id) & F.col("bronze_can_promote")).groupBy("dataset").agg(
        F.count_if(F.col("silver_injest_start_time").isNotNull()).alias("promoted"), F.coalesce(F.sum("silver_rows_created"), F.lit(0)).alias("created"),
        F.coalesce(F.sum("silver_rows_failed"), F.lit(0)).alias("failed"), F.count_if(F.col("silver_errors").isNotNull()).alias("errors"),
    )


def run_history(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("run_id").agg(
        F.min("bronze_injest_start_time").alias("started"), F.max("bronze_injest_start_time").alias("ended"), F.count(F.lit(1)).alias("files"), F.count_if(_failed()).alias("failed"),
        F.coalesce(F.sum("silver_rows_created"), F.lit(0)).alias("silver_rows"),
    )


def gold_rows(builds: DataFrame, counts: str = "row_counts") -> DataFrame:
    """Per run: sum of the numbers in a text of ``table=count`` entries."""
    numbers = F.regexp_extract_all(F.col(counts), F.lit(r"[=:]\s*([0-9]+)"), F.lit(1))
    total = F.aggregate(numbers, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    return builds.groupBy("run_id").agg(F.sum(F.coalesce(total, F.lit(0).cast("bigint"))).alias("gold_rows"))


def recent_errors(manifest: DataFrame, n: int = 100) -> DataFrame:
    rows = manifest.where(_failed()).select("run_id", "file_id", "dataset", "ticker", "bronze_error", "bronze_injest_start_time")
    return rows.orderBy(F.desc_nulls_last("bronze_injest_start_time"), "file_id").limit(n)


def errors_of_run(manifest: DataFrame, run_id: str, n: int = 20) -> DataFrame:
    """First failures of a run in each layer."""
    rows = manifest.where(F.col("run_id") == run_id)
    pick = lambda layer, error: rows.where(F.col(error).isNotNull()).select(F.lit(layer).alias("layer"), "dataset", "ticker", F.col(error).alias("error"), "file_id").orderBy("dataset", F.asc_nulls_first("ticker"), "file_id").limit(n)
    return pick("bronze", "bronze_error").unionByName(pick("silver", "silver_errors"))


def promotable(manifest: DataFrame) -> DataFrame:
    """Files that may be promoted and have not been, or made no rows; oldest start first, nulls last."""
    rows = manifest.where(F.col("bronze_can_promote") & (F.col("silver_injest_start_time").isNull() | (F.coalesce("silver_rows_created", F.lit(0)) == 0)))
    return rows.orderBy(F.asc_nulls_last("bronze_injest_start_time"), F.desc_nulls_last("bronze_to_date"), "file_id")


def lookup(manifest: DataFrame, run_id: str, domain: str, source: str, dataset: str, scope: str = "any", discriminator: str | None = None, ticker: str | None = None) -> DataFrame:
    """Rows of one run and identity; scope ``global`` wants no ticker, ``per_ticker`` one, or the one given."""
    rows = manifest.where((F.col("run_id") == run_id) & (F.col("domain") == domain) & (F.col("source") == source) & (F.col("dataset") == dataset))
    if discriminator is not None:
        rows = rows.where(_blank("discriminator") == discriminator)
    if scope == "global":
        return rows.where(_blank("ticker") == "")
    if scope == "per_ticker":
        return rows.where(_blank("ticker") == ticker if ticker is not None else _blank("ticker") != "")
    return rows


def tickers_with_error(manifest: DataFrame, dataset: str, part: str) -> DataFrame:
    return manifest.where((F.col("dataset") == dataset) & F.col("bronze_error").contains(part) & F.col("ticker").isNotNull()).select("ticker").distinct()


def universe_presence(universe: DataFrame, manifest: DataFrame) -> DataFrame:
    """Universe tickers with whether Bronze, and Silver, hold them."""
    seen = manifest.where("ticker IS NOT NULL").groupBy("ticker").agg(F.lit(True).alias("b"), F.bool_or(F.coalesce("silver_rows_created", F.lit(0)) > 0).alias("s"))
    return universe.select("ticker").distinct().join(seen, "ticker", "left").select("ticker", F.coalesce("b", F.lit(False)).alias("in_bronze"), F.coalesce("s", F.lit(False)).alias("in_silver"))


def universe_datasets(universe: DataFrame, datasets: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per dataset: universe tickers, those with a good file, and those without.

    Counts come from a join on the manifest's own pairs; the full grid of tickers and datasets is never made.
    """
    tickers = universe.select("ticker").distinct()
    good = manifest.where(~_failed()).select("dataset", "ticker").distinct().join(tickers, "ticker", "left_semi")
    have = good.groupBy("dataset").agg(F.count(F.lit(1)).alias("have"))
    size = tickers.agg(F.count(F.lit(1)).alias("universe"))  # one row
    return datasets.select("dataset").distinct().join(have, "dataset", "left").crossJoin(F.broadcast(size)).select("dataset", "universe", F.coalesce("have", F.lit(0)).cast("bigint").alias("have"), (F.col("universe") - F.coalesce("have", F.lit(0))).cast("bigint").alias("lack"))


def universe_totals(presence: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    bronze, silver = F.count_if("in_bronze"), F.count_if("in_silver")
    return presence.agg(n.alias("universe"), bronze.alias("in_bronze"), silver.alias("in_silver"), F.count_if(F.col("in_bronze") & ~F.col("in_silver")).alias("bronze_only"), F.count_if(~F.col("in_bronze")).alias("not_ingested"), F.round(F.try_divide(bronze * 100.0, n), 2).alias("bronze_pct"))


def integrity_event(events: DataFrame, **columns: Column) -> DataFrame:
    """Events in the integrity table's shape; append them to it."""
    return events.select(*[c.alias(n) for n, c in columns.items()])


def integrity_counts(events: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = events if run_id is None else events.where(F.col("run_id") == run_id)
    return rows.groupBy(F.concat_ws(".", "layer", "status").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def integrity_rollup(events: DataFrame, since: Column, failed_only: bool = False) -> DataFrame:
    rows = events.where(F.col("checked_at") >= since)
    rows = rows.where(F.col("status") == "failed") if failed_only else rows
    return rows.groupBy("layer", "dataset", "status").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"))


def record_promotion(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """The manifest after a promotion: results (run_id, file_id, created, failed, from_date, to_date, started, ended,
    error) are written to their files, and files without an error can't be promoted again."""
    names = {"silver_rows_created": "created", "silver_rows_failed": "failed", "silver_from_date": "from_date", "silver_to_date": "to_date", "silver_injest_start_time": "started", "silver_injest_end_time": "ended", "silver_errors": "error"}
    side = results.select("run_id", "file_id", *[F.col(c).alias(f"__{c}") for c in names.values()], F.lit(True).alias("__done"))
    joined = manifest.join(side, ["run_id", "file_id"], "left")
    kept = {m: F.when(F.col("__done"), F.col(f"__{r}")).otherwise(F.col(m)) for m, r in names.items()}
    kept["bronze_can_promote"] = F.when(F.col("__done") & F.col("__error").isNull(), F.lit(False)).otherwise(F.col("bronze_can_promote"))
    return joined.select(*[kept[c].alias(c) if c in kept else F.col(c) for c in manifest.columns])


def start_build(builds: DataFrame, run_id: str, model_version: str, started_at: Column) -> DataFrame:
    """Audit rows with one more build, numbered after the last."""
    fresh = builds.agg((F.coalesce(F.max("gold_build_id"), F.lit(0)) + 1).cast("bigint").alias("gold_build_id")).select("gold_build_id", F.lit(run_id).alias("run_id"), F.lit(model_version).alias("model_version"), started_at.alias("started_at"))
    return builds.unionByName(fresh, allowMissingColumns=True)


def finish_build(builds: DataFrame, outcome: DataFrame) -> DataFrame:
    """Audit rows after `outcome` (gold_build_id, finished_at, tables_built, row_counts, status) is known."""
    side = builds.drop(*[c for c in outcome.columns if c != "gold_build_id"]).join(outcome, "gold_build_id")
    return upsert(builds, side.select(*builds.columns), ["gold_build_id"])
