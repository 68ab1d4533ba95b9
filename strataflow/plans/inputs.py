"""The engine's input tables, derived from the star-schema test tables: Spark frames and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once in a process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, date, low, adj_close, volume): a supplier's shipments of a day as one bar."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("date"), "l_extendedprice")
    bars = items.groupBy("l_suppkey", "date").agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("adj_close"), F.count(F.lit(1)).alias("volume"))
    return bars.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), "date", "low", "adj_close", "volume")


PRICES = """prices AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS low,
         max(l_extendedprice) AS adj_close, count(*) AS volume
  FROM lineitem GROUP BY ALL)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingestion manifest: an event is a file, its type the dataset, its user the ticker."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    i, kind = F.col("event_id"), F.col("event_type")
    day, rows = F.col("ts").cast("date"), F.floor("value").cast("bigint")
    error = F.when((kind == "error") | (i % 17 == 0), F.concat(F.lit("http "), (i % 5 + 500).cast("string")))
    good = error.isNull() & (rows > 0)
    made = F.when(good & (i % 4 != 0), F.floor(F.col("value") / 2).cast("bigint"))
    return e.select(
        F.concat(F.lit("R"), F.lpad((i % 11).cast("string"), 2, "0")).alias("run_id"), F.concat(F.lit("F"), i.cast("string")).alias("file_id"),
        F.when(kind.isin("view", "click"), "eod").when(kind == "error", "quarter").otherwise("annual").alias("domain"), F.lit("vendor").alias("source"), kind.alias("dataset"),
        F.when(i % 3 == 0, F.concat(F.lit("p"), (i % 2).cast("string"))).alias("discriminator"),
        F.when(kind != "signup", F.concat(F.lit("T"), F.lpad((F.col("user_id") % 60).cast("string"), 3, "0"))).alias("ticker"),
        error.alias("bronze_error"), rows.alias("bronze_rows"), F.date_sub(day, (i % 900).cast("int")).alias("bronze_from_date"), day.alias("bronze_to_date"),
        F.col("ts").alias("bronze_injest_start_time"), F.expr("timestampadd(MILLISECOND, CAST(floor(value * 10) AS INT), ts)").alias("bronze_injest_end_time"),
        good.alias("bronze_can_promote"), F.md5("props").alias("bronze_payload_hash"),
        made.alias("silver_rows_created"), F.when(i % 23 == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("silver_rows_failed"),
        F.when(made.isNotNull(), F.date_sub(day, 3)).alias("silver_from_date"), F.when(made.isNotNull(), day).alias("silver_to_date"),
        F.when(made.isNotNull(), F.col("ts")).alias("silver_injest_start_time"), F.when(i % 23 == 0, F.lit("row failed")).alias("silver_errors"),
    )


MANIFEST = """m0 AS (
  SELECT *, CAST(ts AS DATE) AS d, CAST(floor(value) AS BIGINT) AS n,
         CASE WHEN event_type = 'error' OR event_id % 17 = 0 THEN 'http ' || CAST(event_id % 5 + 500 AS VARCHAR) END AS err
  FROM events),
m1 AS (SELECT *, err IS NULL AND n > 0 AS good FROM m0),
m2 AS (SELECT *, CASE WHEN good AND event_id % 4 <> 0 THEN CAST(floor(value / 2) AS BIGINT) END AS made FROM m1),
manifest AS (
  SELECT 'R' || lpad(CAST(event_id % 11 AS VARCHAR), 2, '0') AS run_id, 'F' || CAST(event_id AS VARCHAR) AS file_id,
         CASE WHEN event_type IN ('view', 'click') THEN 'eod' WHEN event_type = 'error' THEN 'quarter' ELSE 'annual' END AS domain,
         'vendor' AS source, event_type AS dataset, CASE WHEN event_id % 3 = 0 THEN 'p' || CAST(event_id % 2 AS VARCHAR) END AS discriminator,
         CASE WHEN event_type <> 'signup' THEN 'T' || lpad(CAST(user_id % 60 AS VARCHAR), 3, '0') END AS ticker,
         err AS bronze_error, n AS bronze_rows, d - CAST(event_id % 900 AS INTEGER) AS bronze_from_date, d AS bronze_to_date,
         ts AS bronze_injest_start_time, ts + to_milliseconds(CAST(floor(value * 10) AS BIGINT)) AS bronze_injest_end_time,
         good AS bronze_can_promote, md5(props) AS bronze_payload_hash, made AS silver_rows_created,
         CAST(CASE WHEN event_id % 23 = 0 THEN 1 ELSE 0 END AS BIGINT) AS silver_rows_failed,
         CASE WHEN made IS NOT NULL THEN d - 3 END AS silver_from_date, CASE WHEN made IS NOT NULL THEN d END AS silver_to_date,
         CASE WHEN made IS NOT NULL THEN ts END AS silver_injest_start_time, CASE WHEN event_id % 23 = 0 THEN 'row failed' END AS silver_errors
  FROM m2)"""


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual statements: a customer is a company, a year's orders its accounts."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("calendar_year"), "o_totalprice")
    totals = o.groupBy(F.col("o_custkey").alias("instrument_sk"), "calendar_year").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"),
    )
    c = F.col
    return totals.select(
        "instrument_sk", "calendar_year", "revenue", (c("revenue") - c("hi") * 0.3).alias("gross_profit"), F.when(c("n") > 1, c("revenue") - c("hi")).alias("operating_income"),
        (c("lo") - c("hi") * 0.1).alias("free_cash_flow"), (c("hi") * 0.01).alias("research_and_development_expenses"), (c("revenue") * 0.05 + c("lo") * 0.01).alias("selling_general_and_administrative_expenses"),
        (c("hi") * 0.002).alias("interest_expense"), (c("revenue") - c("hi")).alias("income_before_tax"), (c("lo") * 0.2).alias("income_tax_expense"), (c("hi") * 2 + c("lo")).alias("total_assets"),
        F.when(c("instrument_sk") % 5 == 0, F.lit(0.0)).otherwise(c("hi")).alias("total_debt"), c("lo").alias("total_stockholders_equity"), (c("lo") * 0.02).alias("deferred_revenue"),
        (c("lo") * 0.1).alias("goodwill_and_intangible_assets"), F.when(c("instrument_sk") % 13 != 0, c("lo") / c("hi") * 0.3).alias("roic"), (c("hi") + c("lo")).alias("invested_capital"),
    )


ANNUAL = """a0 AS (
  SELECT o_custkey AS instrument_sk, CAST(year(o_orderdate) AS INTEGER) AS calendar_year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         count(*) AS n, max(o_totalprice) AS hi, min(o_totalprice) AS lo
  FROM orders GROUP BY ALL),
annual AS (
  SELECT instrument_sk, calendar_year, revenue, revenue - hi * 0.3::DOUBLE AS gross_profit, CASE WHEN n > 1 THEN revenue - hi END AS operating_income,
         lo - hi * 0.1::DOUBLE AS free_cash_flow, hi * 0.01::DOUBLE AS research_and_development_expenses, revenue * 0.05::DOUBLE + lo * 0.01::DOUBLE AS selling_general_and_administrative_expenses,
         hi * 0.002::DOUBLE AS interest_expense, revenue - hi AS income_before_tax, lo * 0.2::DOUBLE AS income_tax_expense, hi * 2 + lo AS total_assets,
         CASE WHEN instrument_sk % 5 = 0 THEN 0.0::DOUBLE ELSE hi END AS total_debt, lo AS total_stockholders_equity, lo * 0.02::DOUBLE AS deferred_revenue,
         lo * 0.1::DOUBLE AS goodwill_and_intangible_assets, CASE WHEN instrument_sk % 13 <> 0 THEN lo / hi * 0.3::DOUBLE END AS roic, hi + lo AS invested_capital
  FROM a0)"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instrument_sk, symbol, country_code, industry_sk, sector_sk, full_time_employees, beta)."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    return c.select(
        k.alias("instrument_sk"), F.col("c_name").alias("symbol"), F.when(k % 7 != 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("country_code"),
        F.when(k % 31 != 0, F.col("c_nationkey") * 100 + F.ascii("c_mktsegment")).alias("industry_sk"), F.col("n_regionkey").alias("sector_sk"), (k % 50).alias("full_time_employees"),
        F.when(k % 3 != 0, F.col("c_acctbal") / 5000).alias("beta"),
    )


COMPANIES = """companies AS (
  SELECT c_custkey AS instrument_sk, c_name AS symbol, CASE WHEN c_custkey % 7 <> 0 THEN 'N' || CAST(c_nationkey AS VARCHAR) END AS country_code,
         CASE WHEN c_custkey % 31 <> 0 THEN c_nationkey * 100 + ascii(c_mktsegment) END AS industry_sk, n_regionkey AS sector_sk,
         c_custkey % 50 AS full_time_employees, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal / 5000 END AS beta
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country_code, erp): some nations have none; nation 1 stands for the home country."""
    n = table(spark, sf_dir, "nation").where("n_nationkey % 4 <> 3")
    return n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_code"), (F.lit(0.04) + F.col("n_nationkey") * 0.001).alias("erp"))


PREMIUMS = """premiums AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS country_code, 0.04::DOUBLE + n_nationkey * 0.001::DOUBLE AS erp FROM nation WHERE n_nationkey % 4 <> 3)"""


def yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, rate): a day's largest quantity less ten as a yield in percent, some beyond what is plausible."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"), "l_quantity")
    return items.groupBy("date").agg((F.max("l_quantity") - F.lit(30.0)).alias("rate"))


YIELDS = """yields AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) - 30.0::DOUBLE AS rate FROM lineitem GROUP BY 1)"""


def recessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, recession_flag): 1 on days of even years in which orders were placed."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"), F.when(F.year("o_orderdate") % 2 == 0, 1).otherwise(0).alias("recession_flag"))


RECESSIONS = """recessions AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS calendar_year FROM orders WHERE year(o_orderdate) % 2 = 0)"""


def screener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stock screener: parts as companies."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("P"), k.cast("string")).alias("symbol"), F.col("p_brand").alias("exchange"), F.col("p_type").alias("sector"), F.element_at(F.split("p_name", " "), 2).alias("industry"),
        F.when(k % 4 == 0, "US").when(k % 4 == 1, "CA").otherwise("GB").alias("country"), (F.col("p_retailprice") * F.col("p_size")).alias("market_cap"), F.col("p_retailprice").alias("price"),
        (F.col("p_size") * 1000).alias("volume"), (k % 20 / 10).alias("beta"), (k % 3).cast("double").alias("dividend"), (k % 9 == 0).alias("is_etf"), (k % 10 == 0).alias("is_fund"), (k % 6 != 0).alias("is_actively_trading"),
    )


SCREENER = """screener AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS symbol, p_brand AS exchange, p_type AS sector, split_part(p_name, ' ', 2) AS industry,
         CASE WHEN p_partkey % 4 = 0 THEN 'US' WHEN p_partkey % 4 = 1 THEN 'CA' ELSE 'GB' END AS country, p_retailprice * p_size AS market_cap,
         p_retailprice AS price, p_size * 1000 AS volume, (p_partkey % 20) / 10.0::DOUBLE AS beta, CAST(p_partkey % 3 AS DOUBLE) AS dividend,
         p_partkey % 9 = 0 AS is_etf, p_partkey % 10 = 0 AS is_fund, p_partkey % 6 <> 0 AS is_actively_trading
  FROM part)"""
