"""Queries over the ingestion manifest and the coverage index."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import coverage as C
from ..operators import distinct_counts as D
from ..operators import fetch_plan as P
from ..operators import ops as O
from ..operators.coverage_state import base_of, correct, fold
from ..sources.storage import new_path
from . import inputs as I
from .registry import query, rounded

TODAY = dt.date(2024, 3, 1)
UNIVERSE_FROM = dt.date(2020, 1, 1)
NOW = dt.datetime(2024, 1, 25)


def meta(spark):
    """Contract facts of the datasets; one is left out, so that defaults show."""
    rows = [("eod", "vendor", "view", True, "per_ticker", True), ("eod", "vendor", "click", False, "per_ticker", False), ("annual", "vendor", "signup", False, "global", False), ("annual", "vendor", "purchase", True, "global", True)]
    return spark.createDataFrame(rows, "domain string, source string, dataset string, is_timeseries boolean, ticker_scope string, is_historical boolean")


META = """meta(domain, source, dataset, is_timeseries, ticker_scope, is_historical) AS (VALUES
  ('eod', 'vendor', 'view', TRUE, 'per_ticker', TRUE), ('eod', 'vendor', 'click', FALSE, 'per_ticker', FALSE),
  ('annual', 'vendor', 'signup', FALSE, 'global', FALSE), ('annual', 'vendor', 'purchase', TRUE, 'global', TRUE))"""
BASE = f"""{I.MANIFEST},
base AS (
  SELECT domain, source, dataset, coalesce(discriminator, '') AS discriminator, coalesce(ticker, '') AS ticker, min(bronze_from_date) AS min_date, max(bronze_to_date) AS max_date,
         count(*) AS total_files, count(*) FILTER (WHERE bronze_can_promote) AS promotable_files, count(DISTINCT run_id) AS ingestion_runs,
         CAST(coalesce(sum(silver_rows_created), 0) AS BIGINT) AS silver_rows_created, CAST(coalesce(sum(silver_rows_failed), 0) AS BIGINT) AS silver_rows_failed,
         count(*) FILTER (WHERE bronze_error IS NOT NULL) AS error_count, max(bronze_injest_start_time) AS last_ingested_at, max(run_id) AS last_run_id
  FROM manifest GROUP BY 1, 2, 3, 4, 5)"""
INDEX = f"""{BASE}, {META},
idx0 AS (
  SELECT base.*, coalesce(meta.is_timeseries, TRUE) AS is_timeseries, coalesce(meta.ticker_scope, 'per_ticker') AS ticker_scope, coalesce(meta.is_historical, TRUE) AS is_historical
  FROM base LEFT JOIN meta USING (domain, source, dataset)),
idx AS (
  SELECT *, CASE WHEN is_historical THEN round(greatest(date_diff('day', min_date, max_date), 0) / date_diff('day', DATE '1990-01-01', DATE '{TODAY}')::DOUBLE, 4) END AS coverage_ratio,
         CASE WHEN is_historical THEN DATE '1990-01-01' ELSE DATE '{UNIVERSE_FROM}' END AS expected_start_date, DATE '{TODAY}' AS expected_end_date,
         round(error_count::DOUBLE / total_files, 4) AS error_rate, CAST(CASE WHEN is_historical THEN 0 ELSE total_files END AS BIGINT) AS snapshot_count,
         CASE WHEN NOT is_historical THEN coalesce(max_date, CAST(last_ingested_at AS DATE)) END AS last_snapshot_date,
         CAST(CASE WHEN NOT is_historical THEN date_diff('day', coalesce(max_date, CAST(last_ingested_at AS DATE)), DATE '{TODAY}') END AS INTEGER) AS age_days
  FROM idx0)"""


def index(spark, sf_dir):
    return C.coverage_index(C.coverage_base(I.manifest(spark, sf_dir)), meta(spark), TODAY, UNIVERSE_FROM)


query("A1_coverage_base", f"WITH {BASE} SELECT * FROM base")(lambda s, d: C.coverage_base(I.manifest(s, d)))
query("A2_coverage_index", f"WITH {INDEX} SELECT * FROM idx")(index)
query("G6_coverage_refresh", f"WITH {INDEX} SELECT domain, source, dataset, discriminator, ticker, coverage_ratio, age_days, error_rate, snapshot_count FROM idx")(
    lambda s, d: index(s, d).select("domain", "source", "dataset", "discriminator", "ticker", "coverage_ratio", "age_days", "error_rate", "snapshot_count")
)


def folded(spark, sf_dir):
    """The state of a manifest that lands in three batches, each folded; files of the first are promoted later."""
    path, state = new_path(spark, "manifest"), new_path(spark, "coverage")
    rows = I.manifest(spark, sf_dir).withColumn("k", F.substring("file_id", 2, 20).cast("bigint") % 3)
    promoted = rows.where("k = 0").drop("k")
    landed = promoted.withColumns({"silver_rows_created": F.lit(None).cast("bigint"), "silver_rows_failed": F.lit(0).cast("bigint")})
    for i in range(3):
        (landed if i == 0 else rows.where(F.col("k") == i).drop("k")).write.parquet(f"{path}/batch={i}")
        fold(spark, path, state)
    return correct(spark, state, "promotion of batch 0", landed, promoted)


query("A1_incremental_coverage", f"WITH {BASE} SELECT * FROM base")(lambda s, d: base_of(folded(s, d)))
query("G6_incremental_index", f"WITH {INDEX} SELECT domain, source, dataset, discriminator, ticker, coverage_ratio, age_days, error_rate, snapshot_count FROM idx")(
    lambda s, d: C.coverage_index(base_of(folded(s, d)), meta(s), TODAY, UNIVERSE_FROM).select("domain", "source", "dataset", "discriminator", "ticker", "coverage_ratio", "age_days", "error_rate", "snapshot_count")
)
SUMMARY = "SELECT domain, source, dataset, count(DISTINCT ticker) AS tickers_covered, round(avg(coverage_ratio), 4) AS avg_coverage_ratio, round(avg(error_rate), 4) AS avg_error_rate, max(last_ingested_at) AS last_ingested_at FROM idx GROUP BY 1, 2, 3"
query("A3_coverage_summary", f"WITH {INDEX} {SUMMARY}")(lambda s, d: C.summary(index(s, d)))
query("L1_weakest_coverage_first", f"WITH {INDEX} {SUMMARY} ORDER BY avg_coverage_ratio ASC NULLS LAST, dataset")(lambda s, d: C.weakest_first(C.summary(index(s, d)), "avg_coverage_ratio", "dataset"))
query(
    "A4_coverage_matrix",
    f"""WITH {INDEX} SELECT dataset, count(DISTINCT ticker) AS tickers_covered, round(avg(coverage_ratio), 6) AS avg_coverage_ratio,
    round(count(*) FILTER (WHERE last_ingested_at > TIMESTAMP '{NOW}' - INTERVAL 7 DAY)::DOUBLE / count(*), 6) AS pct_updated_7d,
    round(median(year(max_date) - year(min_date)), 6) AS median_history_years, CAST(max(date_diff('day', max_date, DATE '{NOW.date()}')) AS INTEGER) AS oldest_max_date_age
    FROM idx GROUP BY dataset""",
)(lambda s, d: rounded(C.matrix(index(s, d), NOW)))
_PAST = "round(avg(coverage_ratio), 4) AS avg_coverage_ratio, min(min_date) AS min_date, max(max_date) AS max_date, min(expected_start_date) AS expected_start_date, max(expected_end_date) AS expected_end_date"
_SNAP = "round(avg(age_days), 1) AS avg_age_days, max(last_snapshot_date) AS last_snapshot_date"
_TAIL = "round(avg(error_rate), 4) AS avg_error_rate, max(last_ingested_at) AS last_ingested_at FROM idx"
_TICK = "count(DISTINCT CASE WHEN ticker <> '' THEN ticker END) AS tickers_covered"
query("A5_per_ticker_historical", f"WITH {INDEX} SELECT domain, source, dataset, {_TICK}, {_PAST}, {_TAIL} WHERE ticker_scope = 'per_ticker' AND is_historical GROUP BY 1, 2, 3")(lambda s, d: C.scope_summary(index(s, d), True, True))
query("A6_per_ticker_snapshot", f"WITH {INDEX} SELECT domain, source, dataset, {_TICK}, {_SNAP}, {_TAIL} WHERE ticker_scope = 'per_ticker' AND NOT is_historical GROUP BY 1, 2, 3")(lambda s, d: C.scope_summary(index(s, d), True, False))
_FILES = "CAST(sum(total_files) AS BIGINT) AS total_files"
query("A7_global_historical", f"WITH {INDEX} SELECT domain, source, dataset, discriminator, {_FILES}, {_PAST}, {_TAIL} WHERE ticker_scope = 'global' AND is_historical GROUP BY 1, 2, 3, 4")(lambda s, d: C.scope_summary(index(s, d), False, True))
query("A8_global_snapshot", f"WITH {INDEX} SELECT domain, source, dataset, discriminator, {_FILES}, {_SNAP}, {_TAIL} WHERE ticker_scope = 'global' AND NOT is_historical GROUP BY 1, 2, 3, 4")(lambda s, d: C.scope_summary(index(s, d), False, False))
query("A9_error_rates", f"WITH {I.MANIFEST} SELECT dataset, count(*) AS total_files, count(bronze_error) AS error_count, round(count(bronze_error) * 100.0::DOUBLE / count(*), 2) AS error_rate_pct FROM manifest GROUP BY 1")(lambda s, d: O.error_rates(I.manifest(s, d)))
query(
    "A10_latency",
    f"""WITH {I.MANIFEST}, t AS (SELECT dataset, date_diff('millisecond', date_trunc('second', bronze_injest_start_time), bronze_injest_start_time) AS x,
    CAST((epoch_us(bronze_injest_end_time) - epoch_us(bronze_injest_start_time)) // 1000 AS DOUBLE) AS ms FROM manifest)
    SELECT dataset, round(avg(ms), 1) AS avg_ms, round(quantile_cont(ms, 0.95), 1) AS p95_ms, round(max(ms), 1) AS max_ms FROM t GROUP BY 1""",
)(lambda s, d: O.latency(I.manifest(s, d)))
query("A11_hash_stability", f"WITH {I.MANIFEST} SELECT dataset, count(bronze_payload_hash) AS total, count(DISTINCT bronze_payload_hash) AS distinct_hashes, round((1.0 - (count(DISTINCT bronze_payload_hash) - 1)::DOUBLE / count(bronze_payload_hash)) * 100, 2) AS stability_pct FROM manifest GROUP BY 1")(
    lambda s, d: O.hash_stability(I.manifest(s, d))
)
_ID = "domain, source, dataset, coalesce(discriminator, '') AS discriminator, coalesce(ticker, '') AS ticker"
BULK = f"SELECT {_ID}, max(CASE WHEN bronze_error IS NULL THEN bronze_injest_start_time END) AS last_ingested_at, max(bronze_to_date) AS last_to_date FROM manifest GROUP BY 1, 2, 3, 4, 5"
POINT = f"SELECT {_ID}, max(bronze_to_date) AS latest_bronze_to, max(bronze_injest_start_time) AS latest_ingestion, max(silver_to_date) AS latest_silver_to, min(bronze_from_date) AS earliest_bronze_from FROM manifest GROUP BY 1, 2, 3, 4, 5"
query("A12_bulk_watermarks", f"WITH {I.MANIFEST} {BULK}")(lambda s, d: O.bulk_watermarks(I.manifest(s, d)))
query("A13_point_watermarks", f"WITH {I.MANIFEST} {POINT}")(lambda s, d: O.point_watermarks(I.manifest(s, d)))
query(
    "A14_input_watermarks",
    f"""WITH {I.MANIFEST}, w AS (SELECT {_ID}, min(silver_from_date) AS a, max(silver_to_date) AS b FROM manifest GROUP BY 1, 2, 3, 4, 5)
    SELECT domain || '/' || source || '/' || dataset || '/' || discriminator || '/' || ticker || ':' || coalesce(CAST(a AS VARCHAR), '') || ':' || coalesce(CAST(b AS VARCHAR), '') AS watermark
    FROM w WHERE a IS NOT NULL OR b IS NOT NULL""",
)(lambda s, d: O.input_watermarks(I.manifest(s, d)))
query(
    "A15_domain_summary",
    f"""WITH {I.MANIFEST} SELECT domain, count(*) AS files, count(bronze_error) AS failed, count(DISTINCT dataset) AS datasets, count(DISTINCT ticker) AS tickers,
    CAST(coalesce(sum(bronze_rows), 0) AS BIGINT) AS rows FROM manifest GROUP BY ROLLUP (domain)""",
)(lambda s, d: O.domain_summary(I.manifest(s, d)))
query(
    "A15_dataset_breakdown",
    f"""WITH {I.MANIFEST} SELECT domain, dataset, count(*) AS files, count(*) - count(bronze_error) AS passed, count(bronze_error) AS failed, CAST(coalesce(sum(bronze_rows), 0) AS BIGINT) AS rows,
    min(bronze_from_date) AS from_date, max(bronze_to_date) AS to_date FROM manifest WHERE run_id = 'R03' GROUP BY 1, 2""",
)(lambda s, d: O.dataset_breakdown(I.manifest(s, d), "R03"))
query(
    "A15_silver_promotion",
    f"""WITH {I.MANIFEST} SELECT dataset, count(silver_injest_start_time) AS promoted, CAST(coalesce(sum(silver_rows_created), 0) AS BIGINT) AS created,
    CAST(coalesce(sum(silver_rows_failed), 0) AS BIGINT) AS failed, count(silver_errors) AS errors FROM manifest WHERE run_id = 'R03' AND bronze_can_promote GROUP BY 1""",
)(lambda s, d: O.silver_promotion(I.manifest(s, d), "R03"))
query(
    "A15_run_history",
    f"""WITH {I.MANIFEST} SELECT run_id, min(bronze_injest_start_time) AS started, max(bronze_injest_start_time) AS ended, count(*) AS files, count(bronze_error) AS failed,
    CAST(coalesce(sum(silver_rows_created), 0) AS BIGINT) AS silver_rows FROM manifest GROUP BY 1""",
)(lambda s, d: O.run_history(I.manifest(s, d)))


@query(
    "A16_gold_rows_per_run",
    """WITH b AS (SELECT 'R' || CAST(event_id % 11 AS VARCHAR) AS run_id, 'fact_a=' || CAST(event_id AS VARCHAR) || ', fact_b: ' || CAST(user_id AS VARCHAR) AS c, event_id + user_id AS n FROM events)
    SELECT run_id, CAST(sum(n) AS BIGINT) AS gold_rows FROM b GROUP BY 1""",
)
def gold_rows(spark, sf_dir):
    e = I.table(spark, sf_dir, "events")
    text = F.concat(F.lit("fact_a="), F.col("event_id").cast("string"), F.lit(", fact_b: "), F.col("user_id").cast("string"))
    return O.gold_rows(e.select(F.concat(F.lit("R"), (F.col("event_id") % 11).cast("string")).alias("run_id"), text.alias("row_counts")))


UNIVERSE = "universe AS (SELECT DISTINCT 'T' || lpad(CAST(c_custkey % 80 AS VARCHAR), 3, '0') AS ticker FROM customer)"
PRESENCE = f"""{I.MANIFEST}, {UNIVERSE},
seen AS (SELECT ticker, bool_or(coalesce(silver_rows_created, 0) > 0) AS s FROM manifest WHERE ticker IS NOT NULL GROUP BY 1),
presence AS (SELECT u.ticker, seen.ticker IS NOT NULL AS in_bronze, coalesce(s, FALSE) AS in_silver FROM universe u LEFT JOIN seen USING (ticker))"""


def universe(spark, sf_dir):
    return I.table(spark, sf_dir, "customer").select(F.concat(F.lit("T"), F.lpad((F.col("c_custkey") % 80).cast("string"), 3, "0")).alias("ticker")).distinct()


def presence(s, d):
    return O.universe_presence(universe(s, d), I.manifest(s, d))


query("J12_universe_presence", f"WITH {PRESENCE} SELECT * FROM presence")(presence)
query(
    "A17_universe_totals",
    f"""WITH {PRESENCE} SELECT count(*) AS universe, count(*) FILTER (WHERE in_bronze) AS in_bronze, count(*) FILTER (WHERE in_silver) AS in_silver,
    count(*) FILTER (WHERE in_bronze AND NOT in_silver) AS bronze_only, count(*) FILTER (WHERE NOT in_bronze) AS not_ingested, round(count(*) FILTER (WHERE in_bronze) * 100.0::DOUBLE / count(*), 2) AS bronze_pct FROM presence""",
)(lambda s, d: O.universe_totals(presence(s, d)))
query(
    "J13_universe_dataset_coverage",
    f"""WITH {I.MANIFEST}, {UNIVERSE}, ds AS (SELECT DISTINCT dataset FROM manifest),
    hit AS (SELECT DISTINCT dataset, ticker FROM manifest WHERE bronze_error IS NULL)
    SELECT ds.dataset, count(*) AS universe, count(hit.ticker) AS have, count(*) - count(hit.ticker) AS lack
    FROM ds CROSS JOIN universe u LEFT JOIN hit ON hit.dataset = ds.dataset AND hit.ticker = u.ticker GROUP BY 1""",
)(lambda s, d: O.universe_datasets(universe(s, d), I.manifest(s, d).select("dataset"), I.manifest(s, d)))
EVENTS = "ev AS (SELECT 'R' || CAST(event_id % 11 AS VARCHAR) AS run_id, event_type AS layer, user_id % 9 AS ds, CASE WHEN event_id % 5 = 0 THEN 'failed' ELSE 'passed' END AS status, CAST(floor(value) AS BIGINT) AS rows_in, CAST(floor(value / 2) AS BIGINT) AS rows_out, ts AS checked_at FROM events)"


def integrity(spark, sf_dir):
    e = I.table(spark, sf_dir, "events")
    return O.integrity_event(
        e, run_id=F.concat(F.lit("R"), (F.col("event_id") % 11).cast("string")), layer=F.col("event_type"), dataset=F.col("user_id") % 9, status=F.when(F.col("event_id") % 5 == 0, "failed").otherwise("passed"),
        rows_in=F.floor("value").cast("bigint"), rows_out=F.floor(F.col("value") / 2).cast("bigint"), checked_at=F.col("ts"),
    )


query("U12_integrity_events", f"WITH {EVENTS} SELECT run_id, layer, ds AS dataset, status, rows_in, rows_out, checked_at FROM ev")(integrity)
query("A18_integrity_counts", f"WITH {EVENTS} SELECT layer || '.' || status AS outcome, count(*) AS n FROM ev WHERE run_id = 'R3' GROUP BY 1")(lambda s, d: O.integrity_counts(integrity(s, d), "R3"))
query(
    "A18_integrity_rollup",
    f"WITH {EVENTS} SELECT layer, ds AS dataset, status, count(*) AS n, CAST(sum(rows_in) AS BIGINT) AS rows_in, CAST(sum(rows_out) AS BIGINT) AS rows_out FROM ev WHERE checked_at >= TIMESTAMP '2024-01-20' AND status = 'failed' GROUP BY 1, 2, 3",
)(lambda s, d: O.integrity_rollup(integrity(s, d), F.lit(dt.datetime(2024, 1, 20)), True))
query("A25_completeness", f"WITH {INDEX} SELECT ticker, round(count(DISTINCT dataset) / 5.0::DOUBLE, 4) AS completeness, round(avg(coverage_ratio), 4) AS mean_coverage, CAST(sum(error_count) AS BIGINT) AS errors, round(sum(error_count) * 100.0::DOUBLE / sum(total_files), 2) AS error_pct FROM idx WHERE ticker <> '' GROUP BY 1")(
    lambda s, d: C.completeness(index(s, d), 5)
)
query("A25_universe_share", f"WITH {INDEX} SELECT dataset, round(count(DISTINCT ticker) * 100.0::DOUBLE / 5280, 2) AS universe_pct FROM idx WHERE ticker <> '' GROUP BY 1")(lambda s, d: C.universe_share(index(s, d), 5280))
PRES = f"""{INDEX}, pr AS (SELECT ticker, min_date, max_date, coverage_ratio FROM idx WHERE dataset = 'view' AND ticker <> ''),
pt AS (SELECT ticker, max(coverage_ratio) AS r FROM pr GROUP BY 1),
pc AS (SELECT ticker FROM (SELECT ticker FROM pt ORDER BY r ASC NULLS LAST, ticker LIMIT 10) UNION SELECT ticker FROM (SELECT ticker FROM pt ORDER BY r DESC NULLS LAST, ticker LIMIT 10)),
py AS (SELECT DISTINCT ticker, CAST(unnest(generate_series(year(min_date), year(max_date))) AS INTEGER) AS year FROM pr WHERE ticker IN (SELECT ticker FROM pc))"""
query("A26_presence", f"WITH {PRES} SELECT * FROM py")(lambda s, d: C.presence(index(s, d), "view", 10))
query("A26_presence_matrix", f'WITH {PRES} SELECT ticker, CAST(max(CASE WHEN year = 2022 THEN 1 ELSE 0 END) AS INTEGER) AS "2022", CAST(max(CASE WHEN year = 2023 THEN 1 ELSE 0 END) AS INTEGER) AS "2023", CAST(max(CASE WHEN year = 2024 THEN 1 ELSE 0 END) AS INTEGER) AS "2024" FROM py GROUP BY 1')(
    lambda s, d: C.presence_matrix(index(s, d), "view", 2022, 2024, 10)
)
query("A27_ratio_histogram", f"WITH {INDEX} SELECT CAST(least(floor(coverage_ratio * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM idx WHERE coverage_ratio IS NOT NULL GROUP BY 1")(lambda s, d: C.ratio_histogram(index(s, d)))
query("A28_distinct_tickers", f"WITH {INDEX} SELECT DISTINCT ticker FROM idx WHERE ticker <> ''")(lambda s, d: C.distinct_values(index(s, d), "ticker"))
query("A28_distinct_datasets", f"WITH {INDEX} SELECT DISTINCT dataset FROM idx")(lambda s, d: C.distinct_values(index(s, d), "dataset"))
query("L3_recent_errors", f"WITH {I.MANIFEST} SELECT run_id, file_id, dataset, ticker, bronze_error, bronze_injest_start_time FROM manifest WHERE bronze_error IS NOT NULL ORDER BY bronze_injest_start_time DESC NULLS LAST, file_id LIMIT 100")(lambda s, d: O.recent_errors(I.manifest(s, d)))
_PICK = "SELECT * FROM (SELECT '{0}' AS layer, dataset, ticker, {1} AS error, file_id FROM manifest WHERE run_id = 'R03' AND {1} IS NOT NULL ORDER BY dataset, ticker ASC NULLS FIRST, file_id LIMIT 20)"
query("L3_run_errors", f"WITH {I.MANIFEST} {_PICK.format('bronze', 'bronze_error')} UNION ALL {_PICK.format('silver', 'silver_errors')}")(lambda s, d: O.errors_of_run(I.manifest(s, d), "R03"))
query("L5_stale_snapshots", f"WITH {INDEX} SELECT dataset, discriminator, ticker, last_snapshot_date, age_days FROM idx WHERE NOT is_timeseries AND age_days >= 33")(lambda s, d: C.stale_snapshots(index(s, d), 33))
query("L6_by_dataset", f"WITH {INDEX} SELECT ticker, discriminator, min_date, max_date, coverage_ratio, total_files, error_count, error_rate, last_ingested_at, is_timeseries FROM idx WHERE dataset = 'view'")(lambda s, d: C.by_dataset(index(s, d), "view"))
query("L6_by_ticker", f"WITH {INDEX} SELECT dataset, discriminator, is_timeseries, min_date, max_date, coverage_ratio, total_files, error_count, error_rate, last_ingested_at, age_days, last_snapshot_date FROM idx WHERE ticker = 'T007'")(lambda s, d: C.by_ticker(index(s, d), "T007"))
query("P22_tickers_with_error", f"WITH {I.MANIFEST} SELECT DISTINCT ticker FROM manifest WHERE dataset = 'view' AND bronze_error LIKE '%502%' AND ticker IS NOT NULL")(lambda s, d: O.tickers_with_error(I.manifest(s, d), "view", "502"))
query("P23_promotable_files", f"WITH {I.MANIFEST} SELECT file_id, dataset, bronze_to_date FROM manifest WHERE bronze_can_promote AND (silver_injest_start_time IS NULL OR coalesce(silver_rows_created, 0) = 0)")(lambda s, d: O.promotable(I.manifest(s, d)).select("file_id", "dataset", "bronze_to_date"))
query("P24_manifest_lookup", f"WITH {I.MANIFEST} SELECT file_id, discriminator FROM manifest WHERE run_id = 'R03' AND domain = 'annual' AND source = 'vendor' AND dataset = 'signup' AND coalesce(ticker, '') = ''")(
    lambda s, d: O.lookup(I.manifest(s, d), "R03", "annual", "vendor", "signup", "global").select("file_id", "discriminator")
)
RES = "res AS (SELECT run_id, file_id, bronze_rows // 3 AS created, bronze_from_date AS f, bronze_to_date AS t, CASE WHEN bronze_rows % 5 = 0 THEN 'bad' END AS e FROM manifest WHERE bronze_can_promote AND silver_rows_created IS NULL)"


@query(
    "U10_record_promotion",
    f"""WITH {I.MANIFEST}, {RES} SELECT m.run_id, m.file_id, CASE WHEN res.file_id IS NOT NULL THEN created ELSE silver_rows_created END AS silver_rows_created,
    CASE WHEN res.file_id IS NOT NULL THEN f ELSE silver_from_date END AS silver_from_date, CASE WHEN res.file_id IS NOT NULL THEN e ELSE silver_errors END AS silver_errors,
    bronze_can_promote AND NOT (res.file_id IS NOT NULL AND e IS NULL) AS bronze_can_promote
    FROM manifest m LEFT JOIN res ON res.run_id = m.run_id AND res.file_id = m.file_id""",
)
def record_promotion(spark, sf_dir):
    m = I.manifest(spark, sf_dir)
    results = m.where("bronze_can_promote AND silver_rows_created IS NULL").select(
        "run_id", "file_id", F.expr("bronze_rows DIV 3").alias("created"), F.lit(0).cast("bigint").alias("failed"), F.col("bronze_from_date").alias("from_date"), F.col("bronze_to_date").alias("to_date"),
        F.col("bronze_injest_start_time").alias("started"), F.col("bronze_injest_end_time").alias("ended"), F.when(F.col("bronze_rows") % 5 == 0, "bad").alias("error"),
    )
    done = O.record_promotion(m, results)
    return done.select("run_id", "file_id", "silver_rows_created", "silver_from_date", "silver_errors", "bronze_can_promote")


CONTRACTS = f"""{I.MANIFEST}, marks AS ({BULK}), contracts AS (SELECT domain, source, dataset, discriminator, ticker, CAST(length(ticker) * length(dataset) % 40 AS INTEGER) AS min_age_days FROM marks
  UNION ALL SELECT 'eod', 'vendor', 'new', '', '', 0)"""


def contracts(marks):
    old = marks.select(*C.IDENTITY, (F.length("ticker") * F.length("dataset") % 40).alias("min_age_days"), (F.length("dataset") % 2 == 0).alias("uses_date_range"))
    fresh = marks.sparkSession.createDataFrame([("eod", "vendor", "new", "", "", 0, True)], "domain string, source string, dataset string, discriminator string, ticker string, min_age_days int, uses_date_range boolean")
    return old.unionByName(fresh)


@query(
    "P16_due_datasets",
    f"""WITH {CONTRACTS} SELECT c.domain, c.source, c.dataset, c.discriminator, c.ticker, coalesce(last_to_date + 1, DATE '1990-01-01') AS from_date, DATE '{TODAY}' AS to_date
    FROM contracts c LEFT JOIN marks USING (domain, source, dataset, discriminator, ticker)
    WHERE (last_ingested_at IS NULL OR (CAST(last_ingested_at AS DATE) < DATE '{TODAY}' AND date_diff('day', CAST(last_ingested_at AS DATE), DATE '{TODAY}') > min_age_days))
      AND coalesce(last_to_date + 1, DATE '1990-01-01') <= DATE '{TODAY}'""",
)
def due(spark, sf_dir):
    marks = O.bulk_watermarks(I.manifest(spark, sf_dir))
    return P.due(contracts(marks), marks, TODAY)


FLOORS = f"""{I.MANIFEST}, marks AS ({POINT}), floors AS (SELECT domain, source, dataset, discriminator, ticker, CASE WHEN length(discriminator) = 0 THEN DATE '1990-01-01' ELSE earliest_bronze_from - 40 END AS floor_date FROM marks WHERE ticker < 'T030')"""
WINDOWS = f"""{FLOORS}, win AS (SELECT domain, source, dataset, discriminator, ticker, least(floor_date, earliest_bronze_from) - 1 AS to_date
  FROM marks LEFT JOIN floors USING (domain, source, dataset, discriminator, ticker) WHERE length(dataset) % 2 = 0),
windows AS (SELECT domain, source, dataset, discriminator, ticker, greatest(to_date - 364, DATE '1990-01-01') AS from_date, to_date FROM win WHERE to_date >= DATE '1990-01-01')"""


def windows(spark, sf_dir):
    marks = O.point_watermarks(I.manifest(spark, sf_dir))
    floor = F.when(F.length("discriminator") == 0, F.lit(C.BASELINE)).otherwise(F.date_sub("earliest_bronze_from", 40))
    floors = marks.where("ticker < 'T030'").select(*C.IDENTITY, floor.alias("floor_date"))
    return P.backward_windows(contracts(marks), marks, floors, 365)


query("P17_backward_windows", f"WITH {WINDOWS} SELECT * FROM windows")(windows)


@query(
    "U3_backfill_floors",
    f"""WITH {WINDOWS} SELECT domain, source, dataset, discriminator, ticker,
    CASE WHEN ascii(right(ticker, 1)) % 3 > 0 AND from_date + 10 <= to_date THEN greatest(from_date + 10, DATE '1990-01-01') ELSE DATE '1990-01-01' END AS floor_date FROM windows""",
)
def floors(spark, sf_dir):
    w = windows(spark, sf_dir)
    results = w.select(*C.IDENTITY, (F.ascii(F.right("ticker", F.lit(1))) % 3).cast("bigint").alias("n_rows"), F.date_add("from_date", 10).alias("earliest"))
    return P.next_floors(w, results)


def ticker_bitmaps(spark, sf_dir) -> str:
    """Bitmaps of a manifest that comes in three batches, one of them twice."""
    path, numbers = new_path(spark, "bitmaps"), new_path(spark, "tickers")
    rows = I.manifest(spark, sf_dir).select("dataset", "ticker", "bronze_injest_start_time", (F.substring("file_id", 2, 20).cast("bigint") % 3).alias("k"))
    for i in (0, 1, 2, 1):
        part = rows.where(F.col("k") == i)
        D.add_rows(part, D.number_tickers(spark, numbers, part), path, F.col("bronze_injest_start_time").cast("date"))
    return path


_GRAINS = {"day": "CAST(bronze_injest_start_time AS DATE)", "week": "CAST(date_trunc('week', bronze_injest_start_time) AS DATE)", "month": "CAST(date_trunc('month', bronze_injest_start_time) AS DATE)"}
_ROLLED = " UNION ALL ".join(f"SELECT '{g}' AS grain, dataset, {e} AS start, count(DISTINCT ticker) AS n_tickers FROM manifest WHERE ticker <> '' GROUP BY ALL" for g, e in _GRAINS.items())


@query("A28_distinct_rollup", f"WITH {I.MANIFEST} {_ROLLED}")
def distinct_rollup(spark, sf_dir):
    """Distinct tickers of each dataset by day, week and month, all from the bitmaps of days."""
    path = ticker_bitmaps(spark, sf_dir)
    parts = [D.distinct_tickers(spark, path, by={"dataset": F.col("dataset"), "start": F.date_trunc(g, "day").cast("date")}).select(F.lit(g).alias("grain"), "dataset", "start", "n_tickers") for g in _GRAINS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_RANGE = (dt.date(2024, 1, 9), dt.date(2024, 1, 20))


@query("A25_universe_share_of_range", f"WITH {I.MANIFEST} SELECT dataset, round(count(DISTINCT ticker) * 100.0::DOUBLE / 60, 2) AS universe_pct FROM manifest WHERE ticker <> '' AND CAST(bronze_injest_start_time AS DATE) BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}' GROUP BY 1")
def universe_share_of_range(spark, sf_dir):
    """Share of 60 tickers that each dataset had files of in a range of days."""
    return D.universe_share(D.distinct_tickers(spark, ticker_bitmaps(spark, sf_dir), *_RANGE), 60)
