"""Queries over universes: definitions, snapshots, filters and eligibility metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import universe as U
from . import inputs as I
from .registry import query, rounded

T = I.table
AS_OF = dt.date(2024, 1, 31)
PRICE_DAY = dt.date(2000, 6, 1)
D = U.UniverseDefinition
#: Six universes over the screener made from parts.
DEFINITIONS = [
    D("us_large", country="US", market_cap_min=30000.0, is_actively_trading=True),
    D("us_small", country="US", market_cap_max=9000.0, is_etf=False, is_fund=False),
    D("brands", exchanges=("Brand#5", "Brand#2", "Brand#9"), price_min=905.0, price_max=1000.0),
    D("income", dividend_min=1.0, beta_max=1.2, volume_min=10000.0),
    D("promo_rings", sector="PROMO", industry="ring"),
    D("funds", is_fund=True, volume_max=30000.0, beta_min=0.5),
]
CONDITIONS = {
    "us_large": "country = 'US' AND market_cap >= 30000 AND is_actively_trading",
    "us_small": "country = 'US' AND market_cap <= 9000 AND NOT is_etf AND NOT is_fund",
    "brands": "exchange IN ('Brand#5', 'Brand#2', 'Brand#9') AND price >= 905 AND price <= 1000",
    "income": "dividend >= 1 AND beta <= 1.2 AND volume >= 10000",
    "promo_rings": "sector = 'PROMO' AND industry = 'ring'",
    "funds": "is_fund AND volume <= 30000 AND beta >= 0.5",
}
MEMBERS = f"{I.SCREENER}, members AS (" + " UNION ".join(f"SELECT '{n}' AS universe_name, DATE '{AS_OF}' AS as_of_date, '{d.filter_hash()}' AS filter_hash, symbol FROM screener WHERE {CONDITIONS[n]}" for n, d in ((d.name, d) for d in DEFINITIONS)) + ")"


def members(s, d):
    return U.snapshot_members(I.screener(s, d), DEFINITIONS, AS_OF)


query("P27_screener_members", f"WITH {MEMBERS} SELECT * FROM members")(members)
query("U13_universe_snapshot", f"WITH {MEMBERS} SELECT universe_name, as_of_date, filter_hash, count(*) AS member_count FROM members GROUP BY 1, 2, 3")(lambda s, d: U.snapshots(members(s, d)))
query("G8_materialise_universes", f"WITH {MEMBERS} SELECT universe_name, count(*) AS member_count, min(symbol) AS first_symbol FROM members GROUP BY 1")(lambda s, d: members(s, d).groupBy("universe_name").agg(F.count(F.lit(1)).alias("member_count"), F.min("symbol").alias("first_symbol")))
query("P26_filter_hash", f"WITH {MEMBERS} SELECT DISTINCT universe_name, filter_hash FROM members")(lambda s, d: members(s, d).select("universe_name", "filter_hash").distinct())
query("P27_screen_limit", f"WITH {I.SCREENER} SELECT symbol FROM screener WHERE country = 'GB' ORDER BY market_cap DESC, symbol LIMIT 30")(lambda s, d: U.screen(I.screener(s, d), D("top", country="GB", limit=30)))
query("P19_in_filters", f"WITH {I.SCREENER} SELECT symbol FROM screener WHERE exchange IN ('Brand#1', 'Brand#4') AND sector IN ('SMALL', 'LARGE')")(lambda s, d: I.screener(s, d).where(U.any_of({"exchange": ["Brand#1", "Brand#4"], "sector": ["SMALL", "LARGE"], "country": []})).select("symbol"))
query("P20_cap_bounds", f"WITH {I.SCREENER} SELECT symbol, market_cap FROM screener WHERE market_cap >= 9000 AND market_cap <= 20000")(lambda s, d: I.screener(s, d).where(U.cap_between(9000, 20000)).select("symbol", "market_cap"))
query("P21_prefix_match", "SELECT DISTINCT p_name AS symbol FROM part WHERE starts_with(p_brand || '-' || p_type, 'Brand#1-')")(
    lambda s, d: U.discriminator_members(T(s, d, "part").select(F.col("p_name").alias("symbol"), F.concat_ws("-", "p_brand", "p_type").alias("discriminator")), "Brand#1")
)
CAPS = "caps AS (SELECT 'P' || CAST(l_partkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS market_cap FROM lineitem GROUP BY 1, 2), latest AS (SELECT ticker, market_cap FROM caps QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)"


def caps(s, d):
    items = T(s, d, "lineitem")
    return items.groupBy(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("ticker"), F.col("l_shipdate").cast("date").alias("date")).agg(F.max("l_extendedprice").alias("market_cap"))


query("J10_latest_cap_in_range", f"WITH {CAPS} SELECT ticker, market_cap FROM latest WHERE market_cap >= 20000 AND market_cap <= 60000")(lambda s, d: U.latest_market_caps(caps(s, d)).where(U.cap_between(20000, 60000)))


def tiers(s, d, *names):
    sc = I.screener(s, d)
    every = {"screener": sc, "profiles": sc.select(F.col("symbol").alias("ticker"), "exchange", "sector", "industry", "country").where("substr(symbol, 2) % 3 <> 0"), "stocks": sc.select("symbol"), "caps": caps(s, d)}
    return {n: every[n] if n in names else every["screener"].where("1 = 0") if n == "screener" else None for n in every}


query("O4_screener_tier", f"WITH {I.SCREENER} SELECT DISTINCT symbol AS ticker FROM screener WHERE sector = 'PROMO' AND market_cap >= 9000")(lambda s, d: U.filtered_tickers(tiers(s, d, "screener", "profiles", "stocks"), {"sector": ["PROMO"]}, low=9000))
query("J11_profile_tier", f"WITH {I.SCREENER}, {CAPS} SELECT symbol AS ticker FROM screener JOIN latest ON ticker = symbol WHERE CAST(substr(symbol, 2) AS INTEGER) % 3 <> 0 AND sector = 'PROMO' AND latest.market_cap <= 60000")(
    lambda s, d: U.filtered_tickers(tiers(s, d, "profiles", "stocks", "caps"), {"sector": ["PROMO"]}, high=60000)
)
query("O4_stock_list_tier", f"WITH {I.SCREENER} SELECT symbol AS ticker FROM screener ORDER BY ticker LIMIT 50")(lambda s, d: U.filtered_tickers(tiers(s, d, "stocks"), {"sector": ["PROMO"]}, limit=50))
query("O5_delisted_tickers", "SELECT DISTINCT p_name AS ticker FROM part WHERE p_size > 40")(lambda s, d: T(s, d, "part").where("p_size > 40").select(F.col("p_name").alias("ticker")).distinct().orderBy("ticker"))
query("L2_page_of_tickers", "SELECT DISTINCT c_name FROM customer ORDER BY 1 LIMIT 25 OFFSET 40")(lambda s, d: U.page(T(s, d, "customer"), "c_name", 40, 25))
DATED = "dated AS (SELECT c_mktsegment AS universe_name, DATE '2024-01-01' + CAST(c_custkey % 9 AS INTEGER) AS as_of_date, c_name AS symbol FROM customer)"


def dated(s, d):
    return T(s, d, "customer").select(F.col("c_mktsegment").alias("universe_name"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("c_custkey") % 9).cast("int")).alias("as_of_date"), F.col("c_name").alias("symbol"))


query("L4_latest_members", f"WITH {DATED} SELECT symbol FROM dated WHERE universe_name = 'BUILDING' AND as_of_date = (SELECT max(as_of_date) FROM dated WHERE universe_name = 'BUILDING')")(lambda s, d: U.members_at(dated(s, d), "BUILDING"))
query("L4_members_at_date", f"WITH {DATED} SELECT symbol FROM dated WHERE universe_name = 'BUILDING' AND as_of_date = DATE '2024-01-04'")(lambda s, d: U.members_at(dated(s, d), "BUILDING", dt.date(2024, 1, 4)))
query("A29_counts", "SELECT count(DISTINCT o_custkey) AS n_update_tickers, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_active FROM orders")(lambda s, d: T(s, d, "orders").agg(F.count_distinct("o_custkey").alias("n_update_tickers"), F.count_if(F.col("o_orderstatus") == "O").alias("n_active")))


def metric_inputs(s, d):
    p = I.prices(s, d).select(F.col("symbol").alias("ticker"), "date", F.col("adj_close").alias("close"), "volume")
    shares = T(s, d, "orders").select(F.concat(F.lit("S"), (F.col("o_custkey") % 120).cast("string")).alias("ticker"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderkey").alias("outstanding_shares"))
    profile = T(s, d, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"), F.lit(AS_OF).alias("as_of_date"), F.concat(F.lit("X"), F.col("s_nationkey").cast("string")).alias("exchange"), F.when(F.col("s_suppkey") % 2 == 0, "even").alias("sector"))
    symbols = T(s, d, "supplier").select(F.concat(F.lit("S"), (F.col("s_suppkey") + 3).cast("string")).alias("symbol"))
    return symbols, p, shares, profile


_DAY = f"DATE '{PRICE_DAY}'"
METRICS = f"""{I.PRICES}, w AS (SELECT DISTINCT 'S' || CAST(s_suppkey + 3 AS VARCHAR) AS symbol FROM supplier),
px AS (SELECT * FROM prices WHERE date <= {_DAY} AND date > CAST({_DAY} - INTERVAL 12 MONTH AS DATE)),
bars AS (SELECT symbol, avg(CASE WHEN date > {_DAY} - 30 THEN adj_close * volume END) AS v30, avg(CASE WHEN date > {_DAY} - 90 THEN adj_close * volume END) AS v90, least(round(count(adj_close) / 252.0::DOUBLE, 4), 1.0) AS cover, max(CASE WHEN date = {_DAY} THEN adj_close END) AS c FROM px GROUP BY 1),
sh AS (SELECT 'S' || CAST(o_custkey % 120 AS VARCHAR) AS symbol, o_orderkey AS n FROM orders WHERE CAST(o_orderdate AS DATE) <= {_DAY} QUALIFY row_number() OVER (PARTITION BY o_custkey % 120 ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1),
pr AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, 'X' || CAST(s_nationkey AS VARCHAR) AS exchange, CASE WHEN s_suppkey % 2 = 0 THEN 'even' END AS sector FROM supplier)"""


def metrics(s, d):
    return U.derived_metrics(*metric_inputs(s, d), PRICE_DAY)


query(
    "G7_derived_metrics",
    f"""WITH {METRICS} SELECT w.symbol, {_DAY} AS as_of_date, round(v30, 6) AS avg_dollar_volume_30d, round(v90, 6) AS avg_dollar_volume_90d, round(cover, 4) AS bar_coverage_1y, round(c * n, 6) AS market_cap, exchange, sector
    FROM w LEFT JOIN bars USING (symbol) LEFT JOIN sh USING (symbol) LEFT JOIN pr USING (symbol)""",
)(lambda s, d: rounded(metrics(s, d)))
query("A21_dollar_volume", f"WITH {METRICS} SELECT symbol, round(v30, 6) AS avg_dollar_volume_30d, round(cover, 4) AS bar_coverage_1y FROM w LEFT JOIN bars USING (symbol)")(lambda s, d: rounded(metrics(s, d).select("symbol", "avg_dollar_volume_30d", "bar_coverage_1y")))
query("A22_market_cap", f"WITH {METRICS} SELECT symbol, round(c * n, 6) AS market_cap FROM w LEFT JOIN bars USING (symbol) LEFT JOIN sh USING (symbol)")(lambda s, d: rounded(metrics(s, d).select("symbol", "market_cap")))
@query(
    "A22_market_cap_dates",
    f"""WITH {I.PRICES}, sh AS (SELECT 'S' || CAST(o_custkey % 120 AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS d, max(o_orderkey) AS n FROM orders GROUP BY 1, 2),
    w AS (SELECT DISTINCT symbol, date FROM prices UNION SELECT symbol, date + 1 FROM prices)
    SELECT w.symbol, w.date AS as_of_date, round(p.adj_close * sh.n, 6) AS market_cap FROM w ASOF LEFT JOIN sh ON w.symbol = sh.symbol AND w.date >= sh.d LEFT JOIN prices p ON p.symbol = w.symbol AND p.date = w.date""",
)
def market_cap_dates(s, d):
    """Market caps of all symbols on each day that they trade, and on the day after, whether they trade then or not."""
    _, p, shares, _ = metric_inputs(s, d)
    days = p.select(F.col("ticker").alias("symbol"), F.col("date").alias("as_of_date"))
    return rounded(U.market_caps(days.union(days.withColumn("as_of_date", F.date_add("as_of_date", 1))), p, shares))


@query(
    "J10_caps_in_range_dates",
    f"""WITH {CAPS}, w AS (SELECT DISTINCT 'P' || CAST(l_partkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) + l_linenumber * 40 AS date FROM lineitem)
    SELECT w.ticker, w.date, market_cap FROM w ASOF JOIN caps ON w.ticker = caps.ticker AND w.date >= caps.date WHERE market_cap BETWEEN 20000 AND 60000 AND w.date - caps.date <= 200""",
)
def caps_in_range_dates(s, d):
    """Parts whose latest cap, up to 200 days old, lies in the range on days after their sales."""
    day = F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber") * 40)
    wanted = T(s, d, "lineitem").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("ticker"), day.alias("date")).distinct()
    return U.caps_in_range(wanted, caps(s, d), 20000, 60000, within=200)


query("J9_restrict_to_symbols", f"WITH {METRICS} SELECT symbol, count(*) AS bars FROM px WHERE symbol IN (SELECT symbol FROM w) GROUP BY 1")(
    lambda s, d: (lambda w, p, *_: p.where((F.col("date") <= F.lit(PRICE_DAY)) & (F.col("date") > F.add_months(F.lit(PRICE_DAY), -12))).join(w.distinct(), F.col("ticker") == F.col("symbol"), "left_semi").groupBy(F.col("ticker").alias("symbol")).agg(F.count(F.lit(1)).alias("bars")))(*metric_inputs(s, d))
)


@query("S11_inline_list", "SELECT symbol, c_custkey FROM (VALUES ('Customer#000000001'), ('Customer#000000005'), ('nobody')) v(symbol) LEFT JOIN customer ON c_name = symbol")
def inline_list(spark, sf_dir):
    wanted = spark.createDataFrame([("Customer#000000001",), ("Customer#000000005",), ("nobody",)], "symbol string")  # a caller's list
    found = T(spark, sf_dir, "customer").join(F.broadcast(wanted), F.col("c_name") == F.col("symbol"), "left_semi").select(F.col("c_name").alias("symbol"), "c_custkey")
    return wanted.join(found, "symbol", "left")
