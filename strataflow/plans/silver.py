"""Queries over Bronze payloads and Silver projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.coerce import coerce, header_map, iso_seconds
from ..functions.dates import is_annual_season
from ..operators import project as P
from ..sources import bronze as B
from ..sources.contracts import contract_from, contract_table, included_plans, load_contracts
from . import inputs as I
from .registry import query

T = I.table
TODAY = dt.date(2024, 2, 1)

# Bronze envelopes, made from events and pages



def envelopes(spark, sf_dir):
    """Payload documents in the shape of the scan: two rows of content each, some broken in one way or another."""
    e = T(spark, sf_dir, "events")
    i = F.col("event_id")
    day = F.concat(F.lit("2024-01-"), F.lpad((i % 28 + 1).cast("string"), 2, "0"))
    first = F.create_map(F.lit("symbol"), F.concat(F.lit("T"), (F.col("user_id") % 60).cast("string")), F.lit("date"), day, F.lit("close"), (i % 97).cast("string"))
    second = F.create_map(F.lit("symbol"), F.lit("X"), F.lit("date"), F.when(i % 5 == 0, "n/a").otherwise("2023-12-31"))
    content = F.when(i % 13 == 0, F.lit(None)).when(i % 7 == 0, F.array().cast("array<map<string,string>>")).otherwise(F.array(first, second))
    request = F.struct(
        F.lit("eod").alias("domain"), F.lit("vendor").alias("source"), F.col("event_type").alias("dataset"), F.lit(None).cast("string").alias("discriminator"), F.lit(None).cast("string").alias("ticker"),
        F.lit("R1").alias("run_id"), i.cast("string").alias("file_id"), F.lit("date").alias("date_key"), F.lit(None).cast("string").alias("from_date"), F.lit(None).cast("string").alias("to_date"), (i % 14 == 0).alias("allow_empty"),
    )
    return e.select(
        i.alias("k"), F.when(i % 29 != 0, request).alias("request"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("now"), (F.floor("value") * 1000).cast("bigint").alias("elapsed_microseconds"),
        F.when(i % 19 != 0, F.lit("a=1; b=2")).otherwise("").alias("headers"), F.when(i % 11 == 0, 500).otherwise(200).alias("status_code"), F.when(i % 11 == 0, "ERR").otherwise("OK").alias("reason"), content.alias("content"),
        F.when(F.col("event_type") == "error", "failed").alias("error"), F.lit(None).cast("string").alias("_corrupt_record"), F.concat(F.lit("/b/eod-"), day, F.lit(".json")).alias("bronze_filename"),
    )


ENV = """env AS (SELECT event_id AS k, event_type, user_id, event_id % 29 <> 0 AS has_request, event_id % 19 <> 0 AS has_headers, CASE WHEN event_id % 11 = 0 THEN 500 ELSE 200 END AS status, event_type = 'error' AS failed,
  CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 0 ELSE 2 END AS n, event_id % 14 = 0 AS allow_empty,
  '2024-01-' || lpad(CAST(event_id % 28 + 1 AS VARCHAR), 2, '0') AS day, CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE '2023-12-31' END AS day2, value FROM events)"""
REJECT = "CASE WHEN NOT has_request THEN 'request missing' WHEN NOT has_headers THEN 'headers missing' WHEN n IS NULL THEN 'content is no list of objects' END"
PROMOTE = "coalesce(status = 200 AND NOT failed AND n IS NOT NULL AND (n > 0 OR (allow_empty AND has_request)), FALSE)"

query("P12_bronze_gate", f"WITH {ENV} SELECT k, {REJECT} AS reason FROM env")(lambda s, d: envelopes(s, d).withColumn("r", B.rejection(envelopes(s, d))).select("k", F.col("r").alias("reason")))
query("P13_promotion_gate", f"WITH {ENV} SELECT k, {PROMOTE} AS ok FROM env")(lambda s, d: envelopes(s, d).select("k", B.can_promote().alias("ok")))
_LEAST = "CASE WHEN n = 2 THEN least(CAST(day AS DATE), TRY_CAST(day2 AS DATE)) END"
_MOST = "CASE WHEN n = 2 THEN greatest(CAST(day AS DATE), TRY_CAST(day2 AS DATE)) END"


@query("P14_boundary_dates", f"WITH {ENV} SELECT k, coalesce({_LEAST}, DATE '{TODAY}') AS first_date, coalesce({_MOST}, DATE '{TODAY}') AS last_date FROM env")
def boundary_dates(spark, sf_dir):
    first, last = B.boundary_dates(F.col("content"), F.lit("date"))
    return envelopes(spark, sf_dir).select("k", F.coalesce(first, F.lit(TODAY)).alias("first_date"), F.coalesce(last, F.lit(TODAY)).alias("last_date"))


@query("P15_payload_hash", f"""WITH {ENV} SELECT k, sha256('[{{"close":"' || CAST(k % 97 AS VARCHAR) || '","date":"' || day || '","symbol":"T' || CAST(user_id % 60 AS VARCHAR) || '"}},{{"date":"' || day2 || '","symbol":"X"}}]') AS hash FROM env WHERE n = 2""")
def payload_hash(spark, sf_dir):
    return envelopes(spark, sf_dir).where("size(content) = 2").select("k", B.payload_hash(F.col("content")).alias("hash"))


@query("S8_bronze_manifest", f"""WITH {ENV} SELECT CASE WHEN has_request THEN CAST(k AS VARCHAR) END AS file_id, CASE WHEN has_request THEN event_type END AS dataset, coalesce({REJECT}, CASE WHEN failed THEN 'failed' END) AS bronze_error, CAST(n AS BIGINT) AS bronze_rows,
    coalesce({_LEAST}, DATE '{TODAY}') AS bronze_from_date, coalesce({_MOST}, DATE '{TODAY}') AS bronze_to_date, {PROMOTE} AND {REJECT} IS NULL AS bronze_can_promote FROM env""")
def manifest(spark, sf_dir):
    return B.bronze_manifest(envelopes(spark, sf_dir), F.lit(TODAY)).select("file_id", "dataset", "bronze_error", "bronze_rows", "bronze_from_date", "bronze_to_date", "bronze_can_promote")


PAYLOAD = f"{ENV}, rows AS (SELECT k, 'T' || CAST(user_id % 60 AS VARCHAR) AS symbol, day AS date, CAST(k % 97 AS VARCHAR) AS close FROM env WHERE n = 2 UNION ALL SELECT k, 'X', day2, NULL FROM env WHERE n = 2)"
query("S1_payload_rows", f"WITH {PAYLOAD} SELECT * FROM rows")(lambda s, d: B.payload_rows(envelopes(s, d)).select("k", *[F.element_at("row", F.lit(c)).alias(c) for c in ("symbol", "date", "close")]))
query("S7_attributes", f"WITH {PAYLOAD} SELECT symbol, close FROM rows WHERE close IS NOT NULL")(lambda s, d: B.attributes(envelopes(s, d), ["symbol", "close"]))
query("S6_file_dates", f"WITH {ENV} SELECT CAST(day AS DATE) AS file_date, count(*) AS n FROM env GROUP BY 1")(lambda s, d: envelopes(s, d).groupBy(B.file_date(F.col("bronze_filename")).alias("file_date")).agg(F.count(F.lit(1)).alias("n")))
query("S6_latest_date", f"WITH {ENV} SELECT max({_MOST}) AS latest FROM env")(lambda s, d: B.latest_date(envelopes(s, d)))


@query("S3_unwrap_key", "SELECT event_id, CAST(CAST(props->>'k' AS INTEGER) AS VARCHAR) AS v FROM events WHERE event_id % 3 = 0")
def unwrap(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    wrapped = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"observations":['), F.col("props"), F.lit("]}"))).otherwise(F.col("props"))
    return e.select("event_id", F.explode(B.unwrap(wrapped, "observations")).alias("m")).select("event_id", F.element_at("m", F.lit("k")).alias("v"))


@query("S4_list_of_values", "SELECT page_id, unnest(string_split(url, '/')) AS value FROM pages")
def values(spark, sf_dir):
    return T(spark, sf_dir, "pages").select("page_id", F.explode(B.wrap_values(F.split("url", "/"))).alias("m")).select("page_id", F.element_at("m", F.lit("value")).alias("value"))


@query("S2_csv_rows", "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, CAST(user_id AS VARCHAR) AS usr FROM events")
def csv_rows(spark, sf_dir):
    """Lines of CSV text, all fields as text."""
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), F.col("user_id").cast("string"))
    return T(spark, sf_dir, "events").select(F.from_csv(line, "id string, kind string, usr string").alias("r")).select("r.*")


query("F1_header_map", "SELECT event_id, CAST(user_id AS VARCHAR) AS a, event_type AS b FROM events")(
    lambda s, d: T(s, d, "events").select("event_id", header_map(F.concat(F.lit("a="), F.col("user_id").cast("string"), F.lit("; b="), F.col("event_type"))).alias("m")).select("event_id", F.element_at("m", F.lit("a")).alias("a"), F.element_at("m", F.lit("b")).alias("b"))
)
query("F1_camel_to_snake", "SELECT event_id, lower(regexp_replace(regexp_replace('adjClose' || upper(left(event_type, 1)) || substr(event_type, 2), '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS name FROM events")(
    lambda s, d: T(s, d, "events").select("event_id", F.lower(F.regexp_replace(F.regexp_replace(F.concat(F.lit("adjClose"), F.initcap("event_type")), "(.)([A-Z][a-z]+)", "$1_$2"), "([a-z0-9])([A-Z])", "$1_$2")).alias("name"))
)
query("F7_sha256", "SELECT event_id, sha256(props) AS h FROM events")(lambda s, d: T(s, d, "events").select("event_id", F.sha2("props", 256).alias("h")))

# Projection

RAW = """raw AS (SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN '2.5' WHEN 1 THEN 'abc' WHEN 2 THEN '.' WHEN 3 THEN NULL WHEN 4 THEN '-3.5' ELSE CAST(user_id AS VARCHAR) END AS v,
  CASE event_id % 7 WHEN 0 THEN 'True' WHEN 1 THEN 'yes' WHEN 2 THEN '1' WHEN 3 THEN 'no' WHEN 4 THEN NULL WHEN 5 THEN ' T ' ELSE '0.4' END AS b,
  CASE event_id % 4 WHEN 0 THEN '2024-02-30' WHEN 1 THEN '2024-01-05' WHEN 2 THEN 'soon' ELSE NULL END AS d FROM events)"""


def raw(spark, sf_dir):
    i = F.col("event_id")
    pick = lambda n, *vs: F.get(F.array(*[v if not isinstance(v, str | None) else F.lit(v) for v in vs]), (i % n).cast("int"))
    return T(spark, sf_dir, "events").select(
        i.alias("id"), pick(6, "2.5", "abc", ".", None, "-3.5", F.col("user_id").cast("string")).alias("v"), pick(7, "True", "yes", "1", "no", None, " T ", "0.4").alias("b"), pick(4, "2024-02-30", "2024-01-05", "soon", None).alias("d"),
    )


query(
    "P4_type_coercion",
    f"""WITH {RAW} SELECT id, coalesce(v, '') AS s, CAST(round_even(TRY_CAST(v AS DOUBLE), 0) AS BIGINT) AS i, TRY_CAST(v AS DOUBLE) AS f,
    coalesce(lower(trim(b)) IN ('true', 't', '1', 'yes', 'y'), FALSE) AS b, TRY_CAST(d AS DATE) AS d FROM raw""",
)(lambda s, d: raw(s, d).select("id", coerce(F.col("v"), "str").alias("s"), coerce(F.col("v"), "int | None").alias("i"), coerce(F.col("v"), "float").alias("f"), coerce(F.col("b"), "bool").alias("b"), coerce(F.col("d"), "date").alias("d")))
query("F5_safe_parse", f"WITH {RAW} SELECT id, TRY_CAST(v AS DOUBLE) AS f, TRY_CAST(d AS DATE) AS d, CAST(CAST(id AS VARCHAR) AS BIGINT) AS i FROM raw")(lambda s, d: raw(s, d).select("id", coerce(F.col("v"), "float").alias("f"), coerce(F.col("d"), "date").alias("d"), coerce(F.col("id").cast("string"), "int").alias("i")))
query("F6_arrays_and_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS v, part FROM (SELECT event_id, props, unnest([event_type, CAST(user_id AS VARCHAR)]) AS part FROM events)")(
    lambda s, d: T(s, d, "events").select("event_id", F.element_at(F.from_json("props", "map<string,string>"), F.lit("k")).alias("v"), F.explode(F.array("event_type", F.col("user_id").cast("string"))).alias("part"))
)


@query("S16_contract_load", "SELECT event_type AS dataset, 'T' || event_type AS silver_table, row_number() OVER (ORDER BY event_type) % 2 = 1 AS per_ticker, count(*) AS files FROM events GROUP BY 1")
def contract_load(spark, sf_dir):
    """Contracts made from configuration entries, validated, and joined with the files of their dataset."""
    entries = [dict(PRICE_CONTRACT, dataset=k, silver_table=f"T{k}", ticker_scope="global" if i % 2 else "per_ticker") for i, k in enumerate(("click", "error", "purchase", "signup", "view"))]
    contracts = load_contracts(entries)
    known = contract_table(spark, contracts).select("dataset", "contract_id", "ticker_scope")
    tables = spark.createDataFrame([(i, c.silver_table) for i, c in enumerate(contracts)], "contract_id int, silver_table string")
    files = T(spark, sf_dir, "events").groupBy(F.col("event_type").alias("dataset")).agg(F.count(F.lit(1)).alias("files"))
    return files.join(known, "dataset").join(tables, "contract_id").select("dataset", "silver_table", (F.col("ticker_scope") == "per_ticker").alias("per_ticker"), "files")


query("P5_iso_times", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS t FROM events")(lambda s, d: T(s, d, "events").select("event_id", iso_seconds(F.col("ts")).alias("t")))
query("P5_defaults", "SELECT event_id, coalesce(CASE WHEN event_id % 3 > 0 THEN event_type END, 'none') AS kind, coalesce(CASE WHEN event_id % 2 > 0 THEN user_id END, -1) AS usr FROM events")(
    lambda s, d: P.with_defaults(T(s, d, "events").select("event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("kind"), F.when(F.col("event_id") % 2 > 0, F.col("user_id")).alias("usr")), {"kind": "none", "usr": -1})
)
PRICE_CONTRACT = {
    "domain": "eod", "source": "vendor", "dataset": "prices", "silver_table": "prices", "key_cols": ["ticker", "date"], "row_date_col": "date",
    "columns": [
        {"name": "ticker", "type": "str"}, {"name": "date", "type": "date"}, {"name": "adj_close", "type": "float", "api": "adjClose"}, {"name": "low", "type": "float"}, {"name": "volume", "type": "int", "api": "tradedVolume"}, {"name": "vwap", "type": "float | None"}, {"name": "note", "type": "str"},
    ],
}


def vendor_prices(spark, sf_dir):
    p = I.prices(spark, sf_dir)
    return p.select(F.col("symbol").alias("ticker"), F.col("date").cast("string").alias("date"), F.col("adj_close").cast("string").alias("adjClose"), F.col("low").alias("low"), F.col("volume").cast("string").alias("tradedVolume"))


def _projected(ticker: str) -> str:
    return f"WITH {I.PRICES} SELECT {ticker} AS ticker, date, adj_close, low, CAST(volume AS BIGINT) AS volume, CAST(NULL AS DOUBLE) AS vwap, '' AS note FROM prices"


query("P3_contract_projection", _projected("symbol"))(lambda s, d: P.project(vendor_prices(s, d), contract_from(PRICE_CONTRACT)))
query("P3_ticker_override", _projected("'AAPL'"))(lambda s, d: P.project(vendor_prices(s, d), contract_from(PRICE_CONTRACT), "AAPL"))
query("P1_snake_aliases", f"WITH {I.PRICES} SELECT date, adj_close + 1 AS adj_close, CAST(volume AS VARCHAR) AS traded_volume FROM prices")(
    lambda s, d: P.add_snake_columns(vendor_prices(s, d).withColumn("adj_close", F.col("adjClose").cast("double") + 1)).select(F.col("date").cast("date").alias("date"), "adj_close", "traded_volume")
)


query("P2_map_keys", f"WITH {PAYLOAD} SELECT k, coalesce(close, '') AS adj_close FROM rows")(
    lambda s, d: B.payload_rows(envelopes(s, d)).select("k", coerce(P.resolve_in_map(F.col("row"), "adj_close", "close"), "str").alias("adj_close"))
)
query("P6_lineage", f"WITH {I.MANIFEST} SELECT file_id AS bronze_file_id, run_id, bronze_injest_start_time AS ingested_at, coalesce(discriminator, '') AS discriminator, bronze_rows AS v FROM manifest")(
    lambda s, d: P.stamp_lineage(I.manifest(s, d).select(F.col("bronze_rows").alias("v"), "file_id", F.col("run_id").alias("r"), "bronze_injest_start_time", F.col("discriminator").alias("x")), F.col("file_id"), F.col("r"), F.col("bronze_injest_start_time"), F.coalesce("x", F.lit(""))).select("bronze_file_id", "run_id", "ingested_at", "discriminator", "v")
)
query("P7_default_row_date", f"WITH {I.MANIFEST} SELECT file_id, coalesce(CASE WHEN bronze_rows % 3 = 0 THEN bronze_to_date END, CASE WHEN bronze_rows % 2 = 0 THEN bronze_from_date END, CAST(bronze_injest_start_time AS DATE)) AS as_of_date FROM manifest")(
    lambda s, d: P.default_row_date(I.manifest(s, d), "as_of_date", F.when(F.col("bronze_rows") % 3 == 0, F.col("bronze_to_date")), F.when(F.col("bronze_rows") % 2 == 0, F.col("bronze_from_date")), F.col("bronze_injest_start_time")).select("file_id", "as_of_date")
)
query("P8_required_keys", "SELECT event_id, user_id FROM events")(lambda s, d: P.require_keys(T(s, d, "events").select("event_id", "user_id"), ["event_id"]))
query("P9_numeric_recoercion", f"WITH {RAW} SELECT id, TRY_CAST(v AS DOUBLE) AS market_cap FROM raw")(lambda s, d: P.recoerce_numeric(raw(s, d).select("id", F.col("v").alias("market_cap")), ["market_cap", "absent"]))
MARKS = "marks AS (SELECT o_orderpriority AS p, max(o_orderdate) - INTERVAL 400 DAY AS m FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)"


def marks(o):
    return o.where("o_orderpriority <> '5-LOW'").groupBy("o_orderpriority").agg((F.max("o_orderdate") - F.expr("INTERVAL 400 DAY")).alias("watermark"))


query("P10_watermark_filter", f"WITH {MARKS} SELECT o_orderkey FROM orders LEFT JOIN marks ON p = o_orderpriority WHERE m IS NULL OR o_orderdate > m")(
    lambda s, d: (lambda o: P.watermark_filter(o, marks(o), ["o_orderpriority"], "o_orderdate").select("o_orderkey"))(T(s, d, "orders"))
)
query("T2_late_rows_global", f"WITH {MARKS} SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT max(m) FROM marks)")(
    lambda s, d: (lambda o: P.watermark_filter(o, marks(o), ["o_orderpriority"], "o_orderdate", mode="global").select("o_orderkey"))(T(s, d, "orders"))
)
CONTRACTS = """contracts AS (SELECT * FROM (VALUES ('eod', 'view', 'p0', 'T003', 0, 'per_ticker'), ('eod', 'view', 'p0', '', 1, 'per_ticker'), ('eod', 'view', '', '', 2, 'per_ticker'), ('annual', 'purchase', '', '', 3, 'global'), ('annual', 'signup', '', '', 4, 'per_ticker')) t(domain, dataset, d, t, c, s))"""


@query(
    "P11_contract_fallbacks",
    f"""WITH {I.MANIFEST}, {CONTRACTS}, j AS (SELECT m.file_id, coalesce(m.ticker, '') AS t, coalesce(a.c, b.c, x.c) AS c, coalesce(a.s, b.s, x.s) AS s FROM manifest m
    LEFT JOIN contracts a ON a.domain = m.domain AND a.dataset = m.dataset AND a.d = coalesce(m.discriminator, '') AND a.t = coalesce(m.ticker, '')
    LEFT JOIN contracts b ON b.domain = m.domain AND b.dataset = m.dataset AND b.d = '' AND b.t = coalesce(m.ticker, '')
    LEFT JOIN contracts x ON x.domain = m.domain AND x.dataset = m.dataset AND x.d = '' AND x.t = '')
    SELECT file_id, CAST(c AS INTEGER) AS contract_id, CASE WHEN c IS NULL THEN 'no contract' WHEN s = 'per_ticker' AND t = '' THEN 'ticker missing' END AS contract_error FROM j""",
)
def contract_fallbacks(spark, sf_dir):
    rows = [("eod", "vendor", "view", "p0", "T003", 0, "per_ticker"), ("eod", "vendor", "view", "p0", None, 1, "per_ticker"), ("eod", "vendor", "view", "", "", 2, "per_ticker"), ("annual", "vendor", "purchase", None, None, 3, "global"), ("annual", "vendor", "signup", "", "", 4, "per_ticker")]
    known = spark.createDataFrame(rows, "domain string, source string, dataset string, discriminator string, ticker string, contract_id int, ticker_scope string")
    return P.resolve_contracts(I.manifest(spark, sf_dir), known).select("file_id", "contract_id", "contract_error")


@query("P18_plan_filter", "SELECT event_type AS dataset, count(*) AS n FROM events WHERE event_type IN ('click', 'signup', 'view') GROUP BY 1")
def plan_filter(spark, sf_dir):
    """Events of the datasets that a plan includes: each plan has those of the plans below it."""
    plans = {"click": ["basic"], "error": ["ultimate"], "purchase": ["premium", "ultimate"], "signup": [], "view": ["starter", "premium"]}
    entries = [dict(PRICE_CONTRACT, dataset=k, recipes=[{"plans": v}]) for k, v in plans.items()]
    chosen = included_plans(contract_table(spark, load_contracts(entries)), "starter", ("basic", "starter", "premium", "ultimate"))
    return T(spark, sf_dir, "events").withColumnRenamed("event_type", "dataset").join(F.broadcast(chosen.select("dataset")), "dataset", "left_semi").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


query("P25_season_flags", "SELECT o_orderkey, month(o_orderdate) IN (1, 2, 3) AS annual FROM orders")(lambda s, d: T(s, d, "orders").select("o_orderkey", is_annual_season(F.col("o_orderdate")).alias("annual")))
query("X1_reshape_hook", f"WITH {PAYLOAD} SELECT k, count(*) AS n FROM rows WHERE close IS NOT NULL GROUP BY 1")(
    lambda s, d: B.payload_rows(envelopes(s, d)).transform(lambda df: df.where(F.element_at("row", F.lit("close")).isNotNull())).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
)
