"""Queries over the star schema: dimensions, facts, price features and the company score."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import business_days, federal_holidays, is_annual_season, is_earnings_season, last_quarter_end
from ..operators import features as W
from ..operators import moat as M
from ..operators import star as S
from ..operators.peers import percent_ranks
from ..operators.upsert import allocate_sk, fill_nulls, latest_per, upsert
from ..sources import dims as D
from ..sources.storage import stored
from . import inputs as I
from .registry import query, rounded

T = I.table

# Calendar and vocabularies

CALENDAR = """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
  dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_us_market_day"""


@query("S12_calendar", f"{CALENDAR} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)")
def calendar(spark, sf_dir):
    """Calendar rows of the days with orders."""
    days = T(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    return D.calendar(spark).join(days, "date", "left_semi")


@query("F2_dates", """SELECT CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS DATE) AS quarter_end, month(o_orderdate) IN (1, 2, 3) AS annual_season,
    month(o_orderdate) IN (1, 2, 3, 4, 5, 7, 8, 10, 11) AS earnings_season, count(*) AS n FROM orders GROUP BY ALL""")
def dates(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return T(spark, sf_dir, "orders").groupBy(d.alias("day"), last_quarter_end(d).alias("quarter_end"), is_annual_season(d).alias("annual_season"), is_earnings_season(d).alias("earnings_season")).agg(F.count(F.lit(1)).alias("n"))


_HOLIDAYS = ", ".join(f"(DATE '{d}')" for y in range(1994, 2004) for d in federal_holidays(y))


@query(
    "F2_next_business_day",
    f"""WITH off(d) AS (VALUES {_HOLIDAYS}), days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), ahead AS (SELECT date, date + CAST(n AS INTEGER) AS day FROM days, generate_series(1, 7) t(n)),
    nxt AS (SELECT date, min(day) AS next_business_day FROM ahead WHERE dayofweek(day) NOT IN (0, 6) AND day NOT IN (SELECT d FROM off) GROUP BY 1)
    SELECT next_business_day, count(*) AS n FROM orders JOIN nxt ON date = CAST(o_orderdate AS DATE) GROUP BY 1""",
)
def next_business_day(spark, sf_dir):
    """Orders by the business day on which they would settle."""
    settled = T(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).join(business_days(spark, 1994, 2002), "date")
    return settled.groupBy("next_business_day").agg(F.count(F.lit(1)).alias("n"))


SEED = """old AS (SELECT CAST(r_regionkey + 1 AS SMALLINT) AS sector_sk, r_name AS sector FROM region), new AS (SELECT CAST(n_nationkey + 1 AS SMALLINT) AS sector_sk, CASE WHEN n_nationkey < 5 THEN (SELECT min(r_name) FROM region) ELSE n_name END AS sector FROM nation WHERE n_nationkey > 2)"""


@query("S13_seed_vocabulary", f"WITH {SEED} SELECT * FROM old UNION ALL SELECT * FROM new WHERE sector NOT IN (SELECT sector FROM old)")
def seed(spark, sf_dir):
    old = T(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).cast("smallint").alias("sector_sk"), F.col("r_name").alias("sector"))
    least = old.agg(F.min("sector").alias("least"))
    new = T(spark, sf_dir, "nation").where("n_nationkey > 2").crossJoin(F.broadcast(least)).select((F.col("n_nationkey") + 1).cast("smallint").alias("sector_sk"), F.when(F.col("n_nationkey") < 5, F.col("least")).otherwise(F.col("n_name")).alias("sector"))
    return D.seed(old, new, ["sector"])


@query("S15_table_sizes", "SELECT 'orders' AS \"table\", count(*) AS n_rows FROM orders UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'absent', -1")
def table_sizes(spark, sf_dir):
    return D.table_sizes({n: T(spark, sf_dir, n) for n in ("orders", "part", "supplier")} | {"absent": D.read_or_none(spark, "no_such_table")})


# Joins into facts

INSTRUMENTS = "instruments AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_suppkey + 1000 AS instrument_sk FROM supplier)"


def instruments(spark, sf_dir):
    s = T(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"), (F.col("s_suppkey") + 1000).alias("instrument_sk"))


FACT_EOD = f"{I.PRICES}, {INSTRUMENTS}, fact_eod AS (SELECT instrument_sk, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_sk, low, adj_close, volume FROM prices JOIN instruments USING (symbol))"


def fact_eod(spark, sf_dir):
    return S.fact_eod(I.prices(spark, sf_dir), instruments(spark, sf_dir), ["low", "adj_close", "volume"])


query("J1_fact_eod", f"WITH {FACT_EOD} SELECT * FROM fact_eod")(fact_eod)
_STAT = "SELECT l_orderkey AS symbol, l_linenumber AS period, CAST(max(year(l_shipdate)) AS INTEGER) AS y, CAST(sum(CAST({1} AS DECIMAL(18,2))) AS DOUBLE) AS {2} FROM lineitem WHERE {0} GROUP BY 1, 2"
STATEMENTS = f"""income AS ({_STAT.format("l_returnflag <> 'Z'", "l_extendedprice", "revenue")}), balance AS ({_STAT.format("l_returnflag = 'A'", "l_quantity", "total_assets")}), cash AS ({_STAT.format("l_linestatus = 'F'", "l_tax", "free_cash_flow")})"""


def statement(spark, sf_dir, condition, column, name):
    rows = T(spark, sf_dir, "lineitem").where(condition)
    return rows.groupBy(F.col("l_orderkey").alias("symbol"), F.col("l_linenumber").alias("period")).agg(F.max(F.year("l_shipdate")).alias("y"), F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias(name))


def statements(spark, sf_dir):
    return statement(spark, sf_dir, "l_returnflag <> 'Z'", "l_extendedprice", "revenue"), statement(spark, sf_dir, "l_returnflag = 'A'", "l_quantity", "total_assets"), statement(spark, sf_dir, "l_linestatus = 'F'", "l_tax", "free_cash_flow")


@query("J2_fact_quarter", f"WITH {STATEMENTS} SELECT symbol, period, income.y, revenue, total_assets, free_cash_flow, CAST(NULL AS DOUBLE) AS net_debt FROM income LEFT JOIN balance USING (symbol, period) LEFT JOIN cash USING (symbol, period)")
def fact_quarter(spark, sf_dir):
    income, balance, cash = statements(spark, sf_dir)
    return S.fact_from_statements(income, [(balance, [("total_assets", "double")]), (cash, [("free_cash_flow", "double")]), (None, [("net_debt", "double")])], ["symbol", "period"])


ANNUALS = f"""{I.ANNUAL}, {I.COMPANIES},
metrics AS (SELECT instrument_sk, calendar_year, roic AS metric_roic, invested_capital AS ic FROM annual WHERE instrument_sk % 4 <> 1), ratios AS (SELECT instrument_sk, calendar_year, gross_profit / revenue AS gross_profit_margin FROM annual WHERE calendar_year > 1996)"""


@query("J3_fact_annual", f"""WITH {ANNUALS} SELECT a.instrument_sk, a.calendar_year, c.symbol, round(a.revenue, 6) AS revenue, round(m.metric_roic, 6) AS metric_roic, round(m.ic, 6) AS ic, round(r.gross_profit_margin, 6) AS gross_profit_margin,
    CAST(NULL AS DOUBLE) AS debt_ratio FROM annual a LEFT JOIN metrics m USING (instrument_sk, calendar_year) LEFT JOIN ratios r USING (instrument_sk, calendar_year) JOIN companies c ON c.instrument_sk = a.instrument_sk""")
def fact_annual(spark, sf_dir):
    a = I.annual(spark, sf_dir).select("instrument_sk", "calendar_year", "revenue", "gross_profit", "roic", "invested_capital")
    metrics = a.where("instrument_sk % 4 <> 1").select("instrument_sk", "calendar_year", F.col("roic").alias("metric_roic"), F.col("invested_capital").alias("ic"))
    ratios = a.where("calendar_year > 1996").select("instrument_sk", "calendar_year", (F.col("gross_profit") / F.col("revenue")).alias("gross_profit_margin"))
    base = a.select("instrument_sk", "calendar_year", "revenue").join(I.companies(spark, sf_dir).select("instrument_sk", "symbol"), "instrument_sk")
    out = S.fact_from_statements(base, [(metrics, [("metric_roic", "double"), ("ic", "double")]), (ratios, [("gross_profit_margin", "double")]), (None, [("debt_ratio", "double")])], ["instrument_sk", "calendar_year"])
    return rounded(out.select("instrument_sk", "calendar_year", "symbol", "revenue", "metric_roic", "ic", "gross_profit_margin", "debt_ratio"))


@query("S14_optional_sources", f"WITH {STATEMENTS} SELECT symbol, period, revenue, CAST(NULL AS DOUBLE) AS total_assets, CAST(NULL AS BIGINT) AS shares FROM income")
def optional(spark, sf_dir):
    income, _, _ = statements(spark, sf_dir)
    absent = D.read_or_none(spark, "no_such_table")
    return S.fact_from_statements(income.drop("y"), [(absent, [("total_assets", "double")]), (absent, [("shares", "bigint")])], ["symbol", "period"])


@query("J4_code_lookups", "SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 2 THEN n_name END AS nation, n_regionkey AS region_sk, CAST(CASE WHEN c_nationkey % 5 <> 2 THEN n_nationkey END AS INTEGER) AS nation_sk, CASE WHEN c_nationkey % 5 <> 2 THEN r_name END AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def code_lookups(spark, sf_dir):
    """Country and region keys by code; blank codes find nothing."""
    n = T(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").alias("nation_sk"), "n_regionkey", "n_nationkey")
    c = T(spark, sf_dir, "customer").join(n.select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 5 != 2, F.col("n_name")).alias("nation"), F.col("n_regionkey").alias("region_sk")), "c_nationkey")
    named = S.lookup_codes(c, {"nation": (n, "n_name", "nation_sk")})
    r = T(spark, sf_dir, "region").select(F.col("r_regionkey").alias("region_sk"), "r_name")
    return named.join(r, "region_sk").select("c_custkey", "nation", "region_sk", "nation_sk", F.when(F.col("nation").isNotNull(), F.col("r_name")).alias("region"))


# Keys and upserts

OLD_NEW = "old AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 3 <> 1), src AS (SELECT o_orderkey AS k, o_custkey AS c, 'N' AS s, o_totalprice + 1 AS p FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 1)"


def old_new(spark, sf_dir):
    o = T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    return o.where("k % 3 <> 1").withColumn("p", F.when(F.col("k") % 6 != 0, F.col("p"))), o.where("k % 2 = 0 OR k % 3 = 1").withColumns({"s": F.lit("N"), "p": F.col("p") + 1})


query("U2_upsert", f"WITH {OLD_NEW} SELECT * FROM old WHERE k NOT IN (SELECT k FROM src) UNION ALL SELECT * FROM src")(lambda s, d: upsert(*old_new(s, d), ["k"]))
query("U5_insert_if_new", f"WITH {OLD_NEW} SELECT * FROM old UNION ALL SELECT * FROM src WHERE k NOT IN (SELECT k FROM old)")(lambda s, d: upsert(*old_new(s, d), ["k"], "insert_only"))
query("U9_coalesce_merge", f"WITH {OLD_NEW} SELECT k, coalesce(old.c, src.c) AS c, coalesce(old.s, src.s) AS s, coalesce(old.p, src.p) AS p FROM old FULL JOIN src USING (k)")(lambda s, d: upsert(*old_new(s, d), ["k"], "coalesce"))
query("J5_new_keys", f"WITH {OLD_NEW} SELECT * FROM src WHERE k NOT IN (SELECT k FROM old)")(lambda s, d: (lambda o, n: n.join(o.select("k"), ["k"], "left_anti"))(*old_new(s, d)))
query("O3_key_subtraction", f"WITH {OLD_NEW} SELECT k FROM old EXCEPT SELECT k FROM src")(lambda s, d: (lambda o, n: o.select("k").join(n.select("k"), "k", "left_anti"))(*old_new(s, d)))
query("J17_exists", f"WITH {OLD_NEW} SELECT k, c FROM old WHERE EXISTS (SELECT 1 FROM src WHERE src.k = old.k)")(lambda s, d: (lambda o, n: S.existing_instruments(o.withColumnRenamed("k", "symbol"), n.withColumnRenamed("k", "symbol")).select(F.col("symbol").alias("k"), "c"))(*old_new(s, d)))
LATEST = "ORDER BY l_shipdate DESC, l_extendedprice DESC, l_suppkey, l_partkey, l_quantity, l_discount, l_tax"


def latest_order():
    return [F.desc("l_shipdate"), F.desc("l_extendedprice"), "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_tax"]


query("U1_keep_last", f"SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber {LATEST}) = 1")(
    lambda s, d: latest_per(T(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], latest_order()).select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
)


@query("U1_silver_merge", f"SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 4 = 0 THEN -1 ELSE l_suppkey END AS l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber {LATEST}) = 1")
def silver_merge(spark, sf_dir):
    """A batch with repeated keys merged into a table that has a quarter of them; those stay as they are."""
    items = T(spark, sf_dir, "lineitem")
    target = items.where("l_orderkey % 4 = 0").select("l_orderkey", "l_linenumber", F.lit(-1).cast("bigint").alias("l_suppkey")).distinct()
    one = latest_per(items, ["l_orderkey", "l_linenumber"], latest_order())
    return upsert(target, one, ["l_orderkey", "l_linenumber"], "insert_only")


query("W5_latest_row", "SELECT l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_extendedprice) = 1")(
    lambda s, d: latest_per(T(s, d, "lineitem"), ["l_suppkey"], [F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_extendedprice"]).select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
)
query("W9_first_per_key", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")(lambda s, d: latest_per(T(s, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice"))


@query("U6_surrogate_keys", "WITH old AS (SELECT s_name AS symbol, CAST(s_suppkey + 5 AS BIGINT) AS sk FROM supplier WHERE s_suppkey % 3 = 0), new AS (SELECT c_name AS symbol FROM customer UNION SELECT s_name FROM supplier) SELECT * FROM old UNION ALL SELECT symbol, (SELECT max(sk) FROM old) + row_number() OVER (ORDER BY symbol) FROM new WHERE symbol NOT IN (SELECT symbol FROM old)")
def surrogate_keys(spark, sf_dir):
    old = T(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_name").alias("symbol"), (F.col("s_suppkey") + 5).cast("bigint").alias("sk"))
    new = T(spark, sf_dir, "customer").select(F.col("c_name").alias("symbol")).union(T(spark, sf_dir, "supplier").select("s_name"))
    return allocate_sk(old, new, ["symbol"], "sk")


FILL = "WITH t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS a, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS b FROM customer), r AS (SELECT o_custkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 25 AS INTEGER) END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS b FROM orders), one AS (SELECT *, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT AS f FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY f DESC, a NULLS LAST, b NULLS LAST) = 1)"


@query("U7_fill_nulls", f"{FILL} SELECT t.k, coalesce(t.a, one.a) AS a, coalesce(t.b, one.b) AS b FROM t LEFT JOIN one USING (k)")
def fill(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    target = c.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("a"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("b"))
    o = T(spark, sf_dir, "orders")
    rich = o.select(F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 2 == 0, (F.col("o_orderkey") % 25).cast("int")).alias("a"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("b"))
    return fill_nulls(target, rich, ["k"], ["a", "b"])


SYMBOLS = "srcs AS (SELECT 0 AS rk, c_mktsegment || CAST(c_custkey % 200 AS VARCHAR) AS symbol, CAST(c_nationkey AS VARCHAR) AS country, 'stock' AS kind FROM customer UNION SELECT 1, 'S' || CAST(l_suppkey AS VARCHAR), NULL, 'price' FROM lineitem UNION SELECT 2, c_mktsegment || CAST(c_custkey % 300 AS VARCHAR), NULL, 'late' FROM customer)"


def symbol_sources(spark, sf_dir):
    c, items = T(spark, sf_dir, "customer"), T(spark, sf_dir, "lineitem")
    sym = lambda n: F.concat("c_mktsegment", (F.col("c_custkey") % n).cast("string"))
    return S.symbol_union(
        [(c, {"symbol": sym(200), "country": F.col("c_nationkey"), "kind": F.lit("stock")}), (items, {"symbol": F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), "kind": F.lit("price")}), (None, {}), (c, {"symbol": sym(300), "kind": F.lit("late")})],
        ["symbol", "country", "kind"],
    )


ONE_SYMBOL = f"{SYMBOLS}, syms AS (SELECT symbol, country, kind FROM srcs QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY rk, symbol, country NULLS LAST, kind) = 1)"
query("O1_symbol_union", f"WITH {ONE_SYMBOL} SELECT * FROM syms")(symbol_sources)
query("O2_distinct", "SELECT DISTINCT p_brand, p_type FROM part")(lambda s, d: T(s, d, "part").select("p_brand", "p_type").distinct())
DIM = f"{ONE_SYMBOL}, dim AS (SELECT symbol, CASE WHEN length(symbol) % 2 = 0 THEN country END AS country, 'old' AS kind, CAST(row_number() OVER (ORDER BY symbol) + 10 AS BIGINT) AS instrument_sk FROM syms WHERE ascii(symbol) % 2 = 0)"


@query(
    "G2_build_dim",
    f"""WITH {DIM} SELECT dim.symbol, coalesce(dim.country, syms.country) AS country, dim.kind, dim.instrument_sk FROM dim JOIN syms USING (symbol)
    UNION ALL SELECT symbol, country, kind, (SELECT max(instrument_sk) FROM dim) + row_number() OVER (ORDER BY symbol) FROM syms WHERE symbol NOT IN (SELECT symbol FROM dim)""",
)
def build_dim(spark, sf_dir):
    """An existing half of the instruments keeps its keys; missing countries are filled, the others come in."""
    syms = symbol_sources(spark, sf_dir)
    even = syms.where(F.ascii("symbol") % 2 == 0)
    keys = allocate_sk(spark.createDataFrame([], "symbol string, n long"), even, ["symbol"], "n")  # the fixture's own keys
    old = even.join(keys, "symbol").select("symbol", F.when(F.length("symbol") % 2 == 0, F.col("country")).alias("country"), F.lit("old").alias("kind"), (F.col("n") + 10).alias("instrument_sk"))
    return S.build_dim(old, syms, ["symbol"], "instrument_sk", ["country"])


@query("G3_upsert_fact", f"WITH {FACT_EOD}, old AS (SELECT instrument_sk, date_sk, -1.0::DOUBLE AS low, adj_close, volume FROM fact_eod WHERE date_sk % 3 <> 1), src AS (SELECT * FROM fact_eod WHERE date_sk % 3 <> 0) SELECT * FROM old WHERE date_sk % 3 = 0 UNION ALL SELECT * FROM src")
def upsert_fact(spark, sf_dir):
    """A build's rows replace those of their key; every row is on one side at least."""
    fact = fact_eod(spark, sf_dir)
    return upsert(fact.where("date_sk % 3 <> 1").withColumn("low", F.lit(-1.0)), fact.where("date_sk % 3 <> 0"), ["instrument_sk", "date_sk"])


query("U4_upsert_eod", f"WITH {FACT_EOD} SELECT instrument_sk, date_sk, CASE WHEN date_sk % 3 = 0 THEN -1.0::DOUBLE ELSE low END AS low, adj_close, volume FROM fact_eod")(upsert_fact)


@query("U4_upsert_quarter", f"WITH {STATEMENTS} SELECT symbol, period, CASE WHEN period % 3 = 0 THEN -1.0::DOUBLE ELSE revenue END AS revenue, total_assets, free_cash_flow FROM income LEFT JOIN balance USING (symbol, period) LEFT JOIN cash USING (symbol, period)")
def upsert_quarter(spark, sf_dir):
    """Of the older build the periods that the newer one lacks are left."""
    fact = fact_quarter(spark, sf_dir).select("symbol", "period", "revenue", "total_assets", "free_cash_flow")
    return upsert(fact.where("period % 3 <> 1").withColumn("revenue", F.lit(-1.0)), fact.where("period % 3 <> 0"), ["symbol", "period"])


@query("U4_upsert_annual", f"WITH {ANNUALS} SELECT a.instrument_sk, a.calendar_year, CASE WHEN a.calendar_year % 3 = 0 THEN -1.0::DOUBLE ELSE round(a.revenue, 6) END AS revenue, round(m.metric_roic, 6) AS metric_roic FROM annual a LEFT JOIN metrics m USING (instrument_sk, calendar_year) JOIN companies c ON c.instrument_sk = a.instrument_sk")
def upsert_annual(spark, sf_dir):
    fact = fact_annual(spark, sf_dir).select("instrument_sk", "calendar_year", "revenue", "metric_roic")
    return upsert(fact.where("calendar_year % 3 <> 1").withColumn("revenue", F.lit(-1.0)), fact.where("calendar_year % 3 <> 0"), ["instrument_sk", "calendar_year"])


query("F3_math", "SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS l, round(sqrt(l_quantity), 6) AS s, round(abs(l_tax - l_discount), 6) AS a, round(least(greatest(l_discount, 0.03), 0.07), 6) AS held, round(l_extendedprice / nullif(l_discount, 0), 6) AS per FROM lineitem")(
    lambda s, d: rounded(T(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.ln("l_extendedprice").alias("l"), F.sqrt("l_quantity").alias("s"), F.abs(F.col("l_tax") - F.col("l_discount")).alias("a"), F.least(F.greatest("l_discount", F.lit(0.03)), F.lit(0.07)).alias("held"), (F.col("l_extendedprice") / F.nullif("l_discount", F.lit(0.0))).alias("per")))
)
query("F4_conditional", "SELECT o_custkey, CAST(sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS BIGINT) AS closed, max(CASE WHEN o_totalprice > 200000 THEN 'large' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'small' END) AS size, coalesce(min(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END), min(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END), 'none') AS priority FROM orders GROUP BY 1")(
    lambda s, d: T(s, d, "orders").groupBy("o_custkey").agg(
        F.sum((F.col("o_orderstatus") == "F").cast("int")).alias("closed"), F.max(F.when(F.col("o_totalprice") > 200000, "large").when(F.col("o_totalprice") > 100000, "middle").otherwise("small")).alias("size"),
        F.coalesce(*[F.min(F.when(F.col("o_orderstatus") == x, F.col("o_orderpriority"))) for x in "PO"], F.lit("none")).alias("priority"),
    )
)


@query("U14_schema_evolution", f"WITH {FACT_EOD} SELECT instrument_sk, date_sk, adj_close AS close, volume, CAST(NULL AS DOUBLE) AS vwap FROM fact_eod")
def evolve(spark, sf_dir):
    return S.evolve(fact_eod(spark, sf_dir), {"vwap": "double"}, ["low"], {"adj_close": "close"})


RESOLVE = "inst AS (SELECT lower(c_name) AS symbol, c_custkey AS instrument_sk, CAST(c_custkey % 8 + 1 AS SMALLINT) AS instrument_type_sk FROM customer), want AS (SELECT DISTINCT upper(trim(c_name)) AS symbol FROM customer JOIN orders ON o_custkey = c_custkey)"


@query("J15_resolve_keys", f"WITH {RESOLVE} SELECT upper(symbol) AS symbol, instrument_sk FROM inst WHERE instrument_type_sk = 2 AND upper(symbol) IN (SELECT symbol FROM want)")
def resolve(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    inst = c.select(F.lower("c_name").alias("symbol"), F.col("c_custkey").alias("instrument_sk"), (F.col("c_custkey") % 8 + 1).cast("smallint").alias("instrument_type_sk"))
    wanted = c.join(T(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.concat(F.lit(" "), F.col("c_name")).alias("symbol"))
    return S.resolve_instruments(wanted, inst, D.vocabulary(spark, D.INSTRUMENT_TYPES, "instrument_type_sk", "instrument_type"), "etf")


@query("J16_exchange_tickers", "SELECT 'P' || CAST(p_partkey AS VARCHAR) AS symbol, p_partkey + 7 AS instrument_sk FROM part WHERE upper(p_brand) IN ('BRAND#3', 'BRAND#11') ORDER BY symbol LIMIT 40")
def exchange_tickers(spark, sf_dir):
    p = I.screener(spark, sf_dir)
    inst = T(spark, sf_dir, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"), (F.col("p_partkey") + 7).alias("instrument_sk"))
    return S.tickers_on_exchanges(p, inst, ["brand#3", "Brand#11"], 40)


DISC = "tgt AS (SELECT c_name AS symbol, 'stock' AS instrument_type, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS exchange, CAST(NULL AS VARCHAR) AS base_currency, CAST(NULL AS VARCHAR) AS quote_currency FROM customer WHERE c_custkey % 3 <> 0), src AS (SELECT DISTINCT CASE WHEN c_custkey % 4 = 0 THEN upper(left(c_mktsegment, 3)) || lpad(CAST(c_custkey % 999 AS VARCHAR), 3, '0') ELSE c_name END AS symbol, CASE WHEN c_custkey % 4 = 0 THEN 'forex' ELSE 'stock' END AS instrument_type, 'X' || CAST(c_nationkey AS VARCHAR) AS exchange FROM customer)"


@query(
    "U9_discovery_merge",
    f"""WITH {DISC}, one AS (SELECT symbol, instrument_type, min(exchange) AS exchange, CASE WHEN instrument_type = 'forex' AND length(symbol) = 6 THEN left(symbol, 3) END AS b, CASE WHEN instrument_type = 'forex' AND length(symbol) = 6 THEN right(symbol, 3) END AS q FROM src GROUP BY 1, 2)
    SELECT symbol, instrument_type, coalesce(tgt.exchange, one.exchange) AS exchange, coalesce(base_currency, b) AS base_currency, coalesce(quote_currency, q) AS quote_currency FROM tgt FULL JOIN one USING (symbol, instrument_type)""",
)
def discovery(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    target = c.where("c_custkey % 3 <> 0").select(F.col("c_name").alias("symbol"), F.lit("stock").alias("instrument_type"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("exchange"), none.alias("base_currency"), none.alias("quote_currency"))
    pair = F.concat(F.upper(F.left("c_mktsegment", F.lit(3))), F.lpad((k % 999).cast("string"), 3, "0"))
    source = c.select(F.when(k % 4 == 0, pair).otherwise(F.col("c_name")).alias("symbol"), F.when(k % 4 == 0, "forex").otherwise("stock").alias("instrument_type"), F.concat(F.lit("X"), F.col("c_nationkey").cast("string")).alias("exchange"))
    return S.merge_discovered(target, source)


@query("U11_build_audit", "WITH b AS (SELECT o_orderkey AS gold_build_id, o_orderstatus AS status FROM orders) SELECT gold_build_id, CASE WHEN gold_build_id % 10 = 0 THEN 'done' ELSE status END AS status FROM b UNION ALL SELECT max(gold_build_id) + 1, NULL FROM b")
def build_audit(spark, sf_dir):
    from ..operators.ops import finish_build, start_build

    b = T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("gold_build_id"), F.col("o_orderstatus").alias("status"))
    finished = finish_build(b, b.where("gold_build_id % 10 = 0").select("gold_build_id", F.lit("done").alias("status")))
    return start_build(finished, "R1", "v1", F.lit(dt.datetime(2024, 1, 1))).select("gold_build_id", "status")


# Price features

_OVER = "(PARTITION BY instrument_sk ORDER BY date_sk)"
FEATURES = f"""{FACT_EOD},
r AS (SELECT *, ln(adj_close / nullif(lag(adj_close) OVER {_OVER}, 0)) AS lr FROM fact_eod WHERE adj_close > 0),
feats AS (SELECT instrument_sk, date_sk, lr, {", ".join(f"adj_close / nullif(lag(adj_close, {n}) OVER {_OVER}, 0) - 1 AS {name}" for name, n in W.MOMENTUM_ROWS.items())},
  stddev_samp(lr) OVER (PARTITION BY instrument_sk ORDER BY date_sk ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) * sqrt(252) AS volatility_30d_f FROM r)"""
_R = lambda *names: ", ".join(f"round({n}, 6) AS {n}" for n in names)


def price_features(spark, sf_dir):
    return rounded(W.price_features(fact_eod(spark, sf_dir), ["instrument_sk"], "date_sk"))


query("G4_price_features", f"WITH {FEATURES} SELECT instrument_sk, date_sk, {_R(*W.MOMENTUM_ROWS, 'volatility_30d_f')} FROM feats")(price_features)
query("W1_log_return", f"WITH {FEATURES} SELECT instrument_sk, date_sk, {_R('lr')} FROM feats")(lambda s, d: rounded(fact_eod(s, d).where("adj_close > 0").select("instrument_sk", "date_sk", W.log_return(F.col("adj_close"), W.series(["instrument_sk"], "date_sk")).alias("lr"))))
query("W2_momentum", f"WITH {FEATURES} SELECT instrument_sk, date_sk, {_R(*W.MOMENTUM_ROWS)} FROM feats")(lambda s, d: price_features(s, d).drop("volatility_30d_f"))
query("W3_volatility", f"WITH {FEATURES} SELECT instrument_sk, date_sk, {_R('volatility_30d_f')} FROM feats")(lambda s, d: price_features(s, d).select("instrument_sk", "date_sk", "volatility_30d_f"))


@query("J18_refresh_features", f"WITH {FEATURES} SELECT f.instrument_sk, f.date_sk, f.volume, CASE WHEN f.date_sk % 2 = 0 THEN round(x.momentum_1m_f, 6) ELSE -9.0::DOUBLE END AS momentum_1m_f FROM fact_eod f LEFT JOIN feats x USING (instrument_sk, date_sk)")
def refresh(spark, sf_dir):
    """Facts whose features are renewed on even days and keep their old value on the others."""
    facts = fact_eod(spark, sf_dir).select("instrument_sk", "date_sk", "volume", F.lit(-9.0).alias("momentum_1m_f"))
    return W.refresh_features(facts, price_features(spark, sf_dir).where("date_sk % 2 = 0").select("instrument_sk", "date_sk", "momentum_1m_f"), ["instrument_sk", "date_sk"])


@query("G4_incremental_features", f"WITH {FEATURES} SELECT instrument_sk, date_sk, {_R(*W.MOMENTUM_ROWS, 'volatility_30d_f')} FROM feats")
def incremental_features(spark, sf_dir):
    """Features of a table that lacked a third of the instruments' rows of some days and had others wrong, renewed: those of a full build."""
    facts = stored(fact_eod(spark, sf_dir).select("instrument_sk", "date_sk", "adj_close"), "prices")
    late = "instrument_sk % 3 = 0 AND date_sk % 100 = 15 AND date_sk > 19950000"
    old = facts.where(f"NOT ({late})").withColumn("adj_close", F.when(F.expr("instrument_sk % 7 = 1 AND date_sk % 1000 = 503"), F.col("adj_close") * 1.5).otherwise(F.col("adj_close")))
    key = ["instrument_sk", "date_sk"]
    features = stored(W.price_features(old, key[:1], key[1]), "features")
    return rounded(W.renewed_price_features(facts, features, W.changed_rows(old, facts, key, "adj_close"), key[:1], key[1]))


# Company score

RATES = "rates AS (SELECT CAST(year(date) AS INTEGER) AS calendar_year, avg(CASE WHEN rate BETWEEN 0 AND 20 THEN rate END) / 100 AS rf FROM yields GROUP BY 1)"
MARKET = f"""{I.ANNUAL}, {I.COMPANIES}, {I.PREMIUMS}, {I.YIELDS}, {RATES}, {I.RECESSIONS},
base AS (SELECT a.*, c.symbol, c.country_code, c.industry_sk, c.sector_sk, c.full_time_employees, coalesce(c.beta, 1.0::DOUBLE) AS beta,
  coalesce(p.erp, (SELECT erp FROM premiums WHERE country_code = 'N1'), 0.055::DOUBLE) AS erp, coalesce(r.rf, 0.04::DOUBLE) AS rf
  FROM annual a JOIN companies c USING (instrument_sk) LEFT JOIN premiums p USING (country_code) LEFT JOIN rates r USING (calendar_year))"""


def market(spark, sf_dir):
    c = I.companies(spark, sf_dir)
    facts = I.annual(spark, sf_dir).join(c.drop("beta"), "instrument_sk")
    return M.with_market_inputs(facts, c.select("symbol", "beta"), I.premiums(spark, sf_dir), M.risk_free(I.yields(spark, sf_dir)), home="N1")


query("A20_risk_free", f"WITH {I.YIELDS}, {RATES} SELECT calendar_year, round(rf, 6) AS rf FROM rates")(lambda s, d: rounded(M.risk_free(I.yields(s, d))))
query("A20_recession_years", f"WITH {I.RECESSIONS} SELECT * FROM recessions")(lambda s, d: M.recession_years(I.recessions(s, d)))
query("J6_market_inputs", f"WITH {MARKET} SELECT instrument_sk, calendar_year, {_R('beta', 'erp', 'rf')} FROM base")(lambda s, d: rounded(market(s, d).select("instrument_sk", "calendar_year", "beta", "erp", "rf")))
ONE_ROW = ("wacc", "roic", "gross_margin", "operating_margin", "fcf_margin", "deferred_rev_pct", "sm_pct", "cogs_ratio", "sga_ratio", "asset_turnover", "rev_per_employee", "rd_pct", "intangibles_pct")
_SGA, _RD = "selling_general_and_administrative_expenses", "research_and_development_expenses"
RAW = f"""{MARKET},
raw AS (SELECT *, greatest(0.04, least(0.25, CASE WHEN total_debt + total_stockholders_equity <= 0 THEN 0.08 ELSE
    total_stockholders_equity / nullif(total_debt + total_stockholders_equity, 0) * greatest(0.04, rf + greatest(0.0, beta) * erp)
    + total_debt / nullif(total_debt + total_stockholders_equity, 0) * greatest(0.02, least(0.30, CASE WHEN total_debt > 0 AND interest_expense > 0 THEN interest_expense / total_debt ELSE 0.05 END))
      * (1.0 - greatest(0.0, least(0.5, CASE WHEN income_before_tax > 0 THEN income_tax_expense / income_before_tax ELSE 0.21 END))) END)) AS wacc_raw,
  coalesce(roic, 0.0) AS roic_raw, gross_profit / revenue AS gross_margin_raw, operating_income / revenue AS operating_margin_raw, free_cash_flow / revenue AS fcf_margin_raw,
  deferred_revenue / revenue AS deferred_rev_pct_raw, greatest(0.0, {_SGA} - {_RD}) / revenue AS sm_pct_raw, greatest(0.0, revenue - gross_profit) / revenue AS cogs_ratio_raw,
  {_SGA} / revenue AS sga_ratio_raw, revenue / nullif(total_assets, 0) AS asset_turnover_raw, CASE WHEN full_time_employees > 0 THEN revenue / full_time_employees END AS rev_per_employee_raw,
  {_RD} / revenue AS rd_pct_raw, goodwill_and_intangible_assets / nullif(total_assets, 0) AS intangibles_pct_raw
  FROM base WHERE revenue > 0)"""
_KEYS = ("instrument_sk", "calendar_year")


def ratios(s, d):
    return M.raw_ratios(market(s, d))


_PLAIN = [f"{n}_raw" for n in ONE_ROW[1:] if n != "rev_per_employee"]
query("P28_raw_ratios", f"WITH {RAW} SELECT instrument_sk, calendar_year, {_R(*_PLAIN)}, round(rev_per_employee_raw / 7, 6) AS rev_per_employee FROM raw")(
    lambda s, d: rounded(ratios(s, d).select(*_KEYS, *_PLAIN, (F.col("rev_per_employee_raw") / 7).alias("rev_per_employee")))
)
query("P29_cost_of_capital", f"WITH {RAW} SELECT instrument_sk, calendar_year, {_R('wacc_raw')} FROM raw")(lambda s, d: rounded(ratios(s, d).select(*_KEYS, "wacc_raw")))
_W = "OVER (PARTITION BY instrument_sk ORDER BY calendar_year{0})"
_W0, _W5, _W10 = _W.format(""), _W.format(" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW"), _W.format(" ROWS BETWEEN 9 PRECEDING AND CURRENT ROW")
ROLLED = f"""{RAW},
rb AS (SELECT *, roic_raw - wacc_raw AS roic_spread_raw, avg(roic_raw - wacc_raw) {_W5} AS roic_spread_5y_mean_raw, ((roic_raw - wacc_raw) - lag(roic_raw - wacc_raw, 4) {_W0}) / 4.0 AS roic_spread_trend_raw,
  stddev_samp(operating_margin_raw) {_W5} AS margin_volatility_raw, revenue / nullif(lag(revenue, 1) {_W0}, 0) - 1 AS revenue_growth_raw,
  CASE WHEN abs(invested_capital - lag(invested_capital, 3) {_W0}) > 0 THEN (roic_raw * invested_capital - lag(roic_raw * invested_capital, 3) {_W0}) / abs(invested_capital - lag(invested_capital, 3) {_W0}) END AS incremental_roic_raw
  FROM raw),
rolled AS (SELECT rb.*, avg(CASE WHEN x.calendar_year IS NOT NULL THEN revenue_growth_raw END) OVER (PARTITION BY instrument_sk ORDER BY rb.calendar_year ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS recession_resilience_raw
  FROM rb LEFT JOIN recessions x ON x.calendar_year = rb.calendar_year)"""
LOOK_BACK = ("roic_spread_raw", "roic_spread_5y_mean_raw", "roic_spread_trend_raw", "margin_volatility_raw", "revenue_growth_raw", "incremental_roic_raw", "recession_resilience_raw")


def rolled(s, d):
    return M.rolled(ratios(s, d), M.recession_years(I.recessions(s, d)))


query("W4_rolling_statistics", f"WITH {ROLLED} SELECT instrument_sk, calendar_year, {_R('roic_spread_5y_mean_raw', 'margin_volatility_raw', 'recession_resilience_raw')} FROM rolled")(lambda s, d: rounded(rolled(s, d).select(*_KEYS, "roic_spread_5y_mean_raw", "margin_volatility_raw", "recession_resilience_raw")))
query("W8_lagged_changes", f"WITH {ROLLED} SELECT instrument_sk, calendar_year, {_R('revenue_growth_raw', 'roic_spread_trend_raw', 'incremental_roic_raw')} FROM rolled")(lambda s, d: rounded(rolled(s, d).select(*_KEYS, "revenue_growth_raw", "roic_spread_trend_raw", "incremental_roic_raw")))
query("W10_window_on_window", f"WITH {ROLLED} SELECT instrument_sk, calendar_year, {_R(*LOOK_BACK)} FROM rolled")(lambda s, d: rounded(rolled(s, d).select(*_KEYS, *LOOK_BACK)))
query("J8_recession_marks", f"WITH {ROLLED} SELECT rb.instrument_sk, rb.calendar_year, x.calendar_year IS NOT NULL AS recession FROM rb LEFT JOIN recessions x ON x.calendar_year = rb.calendar_year")(
    lambda s, d: I.annual(s, d).join(M.recession_years(I.recessions(s, d)).withColumn("r", F.lit(True)), "calendar_year", "left").select(*_KEYS, F.coalesce("r", F.lit(False)).alias("recession"))
)
_STATS = ", ".join(f"quantile_cont({f.raw}, 0.01) AS {f.raw}_p01, quantile_cont({f.raw}, 0.99) AS {f.raw}_p99, avg({f.raw}) AS {f.raw}_mean, stddev_samp({f.raw}) AS {f.raw}_std" for f in M.FEATURES)
_STEADY = ", ".join(f"round({f.raw}, 9) AS {f.raw}" for f in M.FEATURES)
STATS = f"""{ROLLED},
steady AS (SELECT * REPLACE ({_STEADY}) FROM rolled),
ind AS (SELECT industry_sk, calendar_year, count(*) AS peer_n, {_STATS} FROM steady WHERE industry_sk IS NOT NULL GROUP BY 1, 2),
sec AS (SELECT sector_sk, calendar_year, count(*) AS peer_n, {_STATS} FROM steady WHERE sector_sk IS NOT NULL GROUP BY 1, 2)"""
_SHOWN = ("gross_margin_raw", "revenue_growth_raw", "margin_volatility_raw")
_COLS = [f"{f}_{s}" for f in _SHOWN for s in ("p01", "p99", "mean", "std")]


def steady(s, d):
    return M.steady(rolled(s, d), 9)


query("A19_peer_stats", f"WITH {STATS} SELECT industry_sk, calendar_year, peer_n, {_R(*_COLS)} FROM ind")(lambda s, d: rounded(M.peer_stats(steady(s, d), ["industry_sk", "calendar_year"], list(_SHOWN))))
query("J7_attach_stats", f"WITH {STATS} SELECT r.instrument_sk, r.calendar_year, ind.peer_n AS industry_n, sec.peer_n AS sector_n FROM rolled r LEFT JOIN ind USING (industry_sk, calendar_year) LEFT JOIN sec ON sec.sector_sk = r.sector_sk AND sec.calendar_year = r.calendar_year")(
    lambda s, d: (lambda r: r.join(M.peer_stats(r, ["industry_sk", "calendar_year"], []).withColumnRenamed("peer_n", "industry_n"), ["industry_sk", "calendar_year"], "left").join(M.peer_stats(r, ["sector_sk", "calendar_year"], []).withColumnRenamed("peer_n", "sector_n"), ["sector_sk", "calendar_year"], "left").select(*_KEYS, "industry_n", "sector_n"))(rolled(s, d))
)


#: The features in which less is better, named here once more for the same reason.
_LOW = ("margin_volatility", "sm_pct", "cogs_ratio", "sga_ratio")


def _norm(f: M.Feature) -> str:
    def score(t: str) -> str:
        held = f"greatest(coalesce({t}.{f.raw}_p01, r.{f.raw}), least(coalesce({t}.{f.raw}_p99, r.{f.raw}), r.{f.raw}))"
        return f"greatest(0.0, least(1.0, (({'-' * (f.name in _LOW)}{held} - coalesce({t}.{f.raw}_mean, r.{f.raw})) / nullif({t}.{f.raw}_std, 0) + 3.0) / 6.0))"

    return f"CASE WHEN r.{f.raw} IS NULL THEN NULL WHEN ind.peer_n >= 10 THEN {score('ind')} WHEN sec.peer_n >= 5 THEN {score('sec')} ELSE 0.5 END AS {f.name}_f"


NORMED = f"""{STATS},
normed AS (SELECT r.instrument_sk, r.calendar_year, r.wacc_raw AS wacc_f, CAST(coalesce(ind.peer_n, 0) AS INTEGER) AS industry_peer_n, CASE WHEN coalesce(ind.peer_n, 0) >= 10 THEN 'industry' ELSE 'sector' END AS benchmark_level,
  percent_rank() OVER (PARTITION BY r.industry_sk, r.calendar_year ORDER BY r.gross_margin_raw ASC NULLS LAST) AS gross_margin_vs_industry_f,
  percent_rank() OVER (PARTITION BY r.industry_sk, r.calendar_year ORDER BY r.operating_margin_raw ASC NULLS LAST) AS operating_margin_vs_industry_f, {", ".join(map(_norm, M.FEATURES))}
  FROM steady r LEFT JOIN ind ON ind.industry_sk = r.industry_sk AND ind.calendar_year = r.calendar_year LEFT JOIN sec ON sec.sector_sk = r.sector_sk AND sec.calendar_year = r.calendar_year)"""
_FS = [f"{f.name}_f" for f in M.FEATURES]
query("P31_normalised_features", f"WITH {NORMED} SELECT instrument_sk, calendar_year, industry_peer_n, benchmark_level, {_R(*_FS)} FROM normed")(lambda s, d: rounded(M.normalised(steady(s, d)).select(*_KEYS, "industry_peer_n", "benchmark_level", *_FS)))
query("W7_percent_rank", f"WITH {NORMED} SELECT instrument_sk, calendar_year, round(operating_margin_vs_industry_f, 6) AS r FROM normed")(lambda s, d: rounded(percent_ranks(steady(s, d), ["industry_sk", "calendar_year"], {"r": "operating_margin_raw"}).select(*_KEYS, "r")))
#: The pillars written out, apart from the library's tables, so that a wrong weight or a lost feature there shows.
_N = "coalesce({}_f, 0.5)".format
_PILLARS = f"""({_N("roic")} + {_N("roic_spread")} + {_N("roic_spread_5y_mean")} + {_N("roic_spread_trend")}) / 4.0 AS profitability_s,
  ({_N("gross_margin")} + {_N("operating_margin")} + {_N("fcf_margin")} + {_N("margin_volatility")} + {_N("recession_resilience")}) / 5.0 AS stability_s,
  ({_N("revenue_growth")} + {_N("gross_margin_vs_industry")} + {_N("operating_margin_vs_industry")}) / 3.0 AS competitive_s,
  ({_N("deferred_rev_pct")} + {_N("sm_pct")}) / 2.0 AS lock_in_s,
  ({_N("cogs_ratio")} + {_N("sga_ratio")} + {_N("asset_turnover")} + {_N("rev_per_employee")}) / 4.0 AS cost_advantage_s,
  ({_N("rd_pct")} + {_N("intangibles_pct")} + {_N("incremental_roic")}) / 3.0 AS reinvestment_s"""
SCORED = f"""{NORMED}, pillars AS (SELECT *, {_PILLARS} FROM normed),
scored AS (SELECT *, 0.30 * profitability_s + 0.25 * stability_s + 0.15 * competitive_s + 0.10 * lock_in_s + 0.15 * cost_advantage_s + 0.05 * reinvestment_s AS moat_score_s FROM pillars)"""
_SS = ["profitability_s", "stability_s", "competitive_s", "lock_in_s", "cost_advantage_s", "reinvestment_s"]


def moat(s, d):
    return M.moat_scores(market(s, d), M.recession_years(I.recessions(s, d)))


query("P30_pillar_scores", f"WITH {SCORED} SELECT instrument_sk, calendar_year, {_R(*_SS)} FROM scored")(lambda s, d: rounded(moat(s, d).select(*_KEYS, *_SS)))
query("G5_moat_score", f"WITH {SCORED} SELECT instrument_sk, calendar_year, industry_peer_n, benchmark_level, {_R('wacc_f', 'moat_score_s', *_SS)} FROM scored")(lambda s, d: rounded(moat(s, d).select(*_KEYS, "industry_peer_n", "benchmark_level", "wacc_f", "moat_score_s", *_SS)))


@query("U4_upsert_moat", f"WITH {SCORED} SELECT instrument_sk, calendar_year, CASE WHEN calendar_year % 3 = 0 THEN -1.0::DOUBLE ELSE round(moat_score_s, 6) END AS moat_score_s, benchmark_level FROM scored")
def upsert_moat(spark, sf_dir):
    fact = rounded(moat(spark, sf_dir).select(*_KEYS, "moat_score_s", "benchmark_level"))
    return upsert(fact.where("calendar_year % 3 <> 1").withColumn("moat_score_s", F.lit(-1.0)), fact.where("calendar_year % 3 <> 0"), list(_KEYS))


query("P33_implausible_wacc", f"WITH {RAW} SELECT instrument_sk, calendar_year, round(wacc_raw, 6) AS wacc_f FROM raw WHERE round(wacc_raw, 6) < 0.05 OR round(wacc_raw, 6) > 0.12 ORDER BY abs(round(wacc_raw, 6) - 0.08) DESC, instrument_sk, calendar_year LIMIT 25")(
    lambda s, d: M.implausible_wacc(ratios(s, d).select(*_KEYS, F.round("wacc_raw", 6).alias("wacc_f")), 0.05, 0.12, 25)
)
_PROFILED = ("gross_margin_raw", "operating_margin_raw", "revenue_growth_raw")
_PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n, round(min({c}), 6) AS least, round(avg({c}), 6) AS mean, round(max({c}), 6) AS most, round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM rolled" for c in _PROFILED)
query("A23_profile", f"WITH {ROLLED} {_PROFILE}")(lambda s, d: rounded(M.profile(rolled(s, d), list(_PROFILED))))
query("A23_fallback_rate", f"WITH {NORMED} SELECT calendar_year, count(*) AS n, count(*) FILTER (WHERE benchmark_level = 'sector') AS n_sector, round(count(*) FILTER (WHERE benchmark_level = 'sector') * 100.0::DOUBLE / count(*), 6) AS sector_pct FROM normed GROUP BY 1")(
    lambda s, d: rounded(M.fallback_rate(M.normalised(steady(s, d), M.FEATURES[:1])))
)
query("A23_momentum_coverage", f"WITH {FEATURES} SELECT instrument_sk, count(momentum_12m_f) AS n FROM feats GROUP BY 1 HAVING count(momentum_12m_f) >= 252")(lambda s, d: price_features(s, d).groupBy("instrument_sk").agg(F.count("momentum_12m_f").alias("n")).where("n >= 252"))
_LATEST = "SELECT * FROM {0} WHERE calendar_year = (SELECT max(calendar_year) FROM {0})"
_NTILE = f"{RAW}, latest AS ({_LATEST.format('raw')}), nt AS (SELECT *, ntile(5) OVER (ORDER BY round(gross_margin_raw, 9) NULLS LAST, instrument_sk) AS quintile FROM latest)"


def scores(s, d):
    return ratios(s, d).select(*_KEYS, F.round("gross_margin_raw", 9).alias("score"))


query("A24_quintiles", f"WITH {_NTILE} SELECT CAST(quintile AS INTEGER) AS quintile, count(*) AS n, round(min(gross_margin_raw), 6) AS least, round(avg(gross_margin_raw), 6) AS mean, round(max(gross_margin_raw), 6) AS most FROM nt GROUP BY 1")(lambda s, d: rounded(M.quintiles(scores(s, d), "score", "instrument_sk")))
query("W6_ntile", f"WITH {_NTILE} SELECT CAST(quintile AS INTEGER) AS quintile, count(*) AS n FROM nt GROUP BY 1")(lambda s, d: M.quintiles(scores(s, d), "score", "instrument_sk").select("quintile", "n"))


@query("L7_named_latest", f"WITH {NORMED} SELECT n.instrument_sk, c.symbol, round(gross_margin_f, 6) AS gross_margin_f FROM normed n JOIN companies c USING (instrument_sk) WHERE calendar_year = (SELECT max(calendar_year) FROM normed) AND c.symbol IN ('Customer#000000003', 'Customer#000000017', 'Customer#000000048')")
def named_latest(spark, sf_dir):
    n = M.normalised(steady(spark, sf_dir), tuple(f for f in M.FEATURES if f.name == "gross_margin"))
    last = n.agg(F.max("calendar_year").alias("calendar_year"))
    return rounded(n.join(F.broadcast(last), "calendar_year").where(F.col("symbol").isin("Customer#000000003", "Customer#000000017", "Customer#000000048")).select("instrument_sk", "symbol", "gross_margin_f"))


SPAN = f"{RAW}, span AS (SELECT instrument_sk, min(calendar_year) AS first_year, max(calendar_year) AS last_year, count(*) AS years FROM raw GROUP BY 1), last AS (SELECT instrument_sk, gross_margin_raw AS score FROM raw QUALIFY row_number() OVER (PARTITION BY instrument_sk ORDER BY calendar_year DESC) = 1)"


def spans(s, d):
    r = ratios(s, d)
    span = r.groupBy("instrument_sk").agg(F.min("calendar_year").alias("first_year"), F.max("calendar_year").alias("last_year"), F.count(F.lit(1)).alias("years"))
    last = latest_per(r.select(*_KEYS, "gross_margin_raw"), ["instrument_sk"], [F.desc("calendar_year")]).select("instrument_sk", F.col("gross_margin_raw").alias("score"))
    return last.join(span, "instrument_sk")


query("J14_latest_with_span", f"WITH {SPAN} SELECT instrument_sk, round(score, 6) AS score, first_year, last_year, years FROM last JOIN span USING (instrument_sk)")(lambda s, d: rounded(spans(s, d)))
query("L8_strongest_first", f"WITH {SPAN} SELECT instrument_sk, round(score, 6) AS score, years FROM last JOIN span USING (instrument_sk) ORDER BY round(score, 6) DESC NULLS LAST, instrument_sk LIMIT 100")(
    lambda s, d: rounded(spans(s, d)).select("instrument_sk", "score", "years").orderBy(F.desc_nulls_last("score"), "instrument_sk").limit(100)
)
_CODES = list(M.COUNTRY_CODES.items())[:25]
_VALUES = ", ".join(f"({i}, '{name}', '{code}')" for i, (name, code) in enumerate(_CODES))


@query("P32_country_codes", f"WITH names(i, country, code) AS (VALUES {_VALUES}) SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN code END AS code FROM customer JOIN names ON i = c_nationkey")
def country_codes(spark, sf_dir):
    names = F.array(*[F.lit(n) for n, _ in _CODES])
    name = F.when(F.col("c_custkey") % 6 == 0, "Atlantis").otherwise(F.get(names, F.col("c_nationkey")))
    return T(spark, sf_dir, "customer").select("c_custkey", M.country_code(name).alias("code"))
