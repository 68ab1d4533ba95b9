"""Instrument universes: definitions, screener evaluation, dated snapshots, eligibility metrics, filtered tickers."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import as_of_join
from .upsert import latest_per


@dataclass(frozen=True)
class UniverseDefinition:
    """Screener conditions; None, or an empty tuple, is no condition."""

    name: str
    country: str | None = None
    exchanges: tuple[str, ...] = ()
    market_cap_min: float | None = None
    market_cap_max: float | None = None
    price_min: float | None = None
    price_max: float | None = None
    volume_min: float | None = None
    volume_max: float | None = None
    beta_min: float | None = None
    beta_max: float | None = None
    dividend_min: float | None = None
    dividend_max: float | None = None
    is_etf: bool | None = None
    is_fund: bool | None = None
    is_actively_trading: bool | None = None
    sector: str | None = None
    industry: str | None = None
    limit: int | None = None

    def parameters(self) -> dict[str, object]:
        """Conditions that are set; exchanges in order."""
        out = {k: v for k, v in asdict(self).items() if k not in ("name", "exchanges") and v is not None}
        return out | ({"exchanges": sorted(self.exchanges)} if self.exchanges else {})

    def filter_hash(self) -> str:
        """SHA-256 of the conditions; the order in which they are given doesn't matter."""
        return hashlib.sha256(json.dumps(self.parameters(), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()

    def condition(self) -> Column:
        """The conditions as a predicate on a screener table; bounds are inclusive."""
        parts = [F.col(c).isin(*v) if c == "exchange" else F.col(c) == v for c, v in (("country", self.country), ("exchange", self.exchanges), ("is_etf", self.is_etf), ("is_fund", self.is_fund), ("is_actively_trading", self.is_actively_trading), ("sector", self.sector), ("industry", self.industry)) if v is not None and v != ()]
        for c in ("market_cap", "price", "volume", "beta", "dividend"):
            low, high = getattr(self, f"{c}_min"), getattr(self, f"{c}_max")
            parts += [F.col(c) >= low] if low is not None else []
            parts += [F.col(c) <= high] if high is not None else []
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def screen(screener: DataFrame, definition: UniverseDefinition, key: str = "symbol") -> DataFrame:
    """Distinct symbols of a universe, the largest first where it has a limit."""
    rows = screener.where(definition.condition())
    if definition.limit is None:
        return rows.select(key).distinct()
    return rows.groupBy(key).agg(F.max("market_cap").alias("__cap")).orderBy(F.desc_nulls_last("__cap"), key).limit(definition.limit).select(key)


def snapshot_members(screener: DataFrame, definitions: list[UniverseDefinition], as_of: dt.date, key: str = "symbol") -> DataFrame:
    """(universe_name, as_of_date, filter_hash, symbol) of all universes, from one pass over the screener."""
    hits = F.filter(F.array(*[F.when(d.condition(), F.struct(F.lit(d.name).alias("u"), F.lit(d.filter_hash()).alias("h"))) for d in definitions]), lambda x: x.isNotNull())
    return screener.select(key, F.explode(hits).alias("x")).select(F.col("x.u").alias("universe_name"), F.lit(as_of).alias("as_of_date"), F.col("x.h").alias("filter_hash"), key).distinct()


def snapshots(members: DataFrame) -> DataFrame:
    """A row per universe and date with its member count."""
    return members.groupBy("universe_name", "as_of_date", "filter_hash").agg(F.count(F.lit(1)).alias("member_count"))


def discriminator_members(screener: DataFrame, universe: str, as_of: dt.date | None = None) -> DataFrame:
    """Distinct symbols of rows whose discriminator begins with the universe's name and a dash."""
    rows = screener.where(F.startswith(F.col("discriminator"), F.lit(f"{universe}-")) & (F.col("symbol") != ""))
    rows = rows if as_of is None else rows.where(F.col("as_of_date") == F.lit(as_of))
    return rows.select("symbol").distinct()


def members_at(members: DataFrame, universe: str, as_of: dt.date | None = None) -> DataFrame:
    """Symbols of a universe at a date, or at its latest one, in order."""
    rows = members.where(F.col("universe_name") == universe)
    if as_of is None:
        rows = rows.join(F.broadcast(rows.agg(F.max("as_of_date").alias("as_of_date"))), "as_of_date", "left_semi")
    else:
        rows = rows.where(F.col("as_of_date") == F.lit(as_of))
    return rows.select("symbol").orderBy("symbol")


def any_of(filters: dict[str, list]) -> Column:
    """Within a column any value will do, and all columns must agree; an empty list is no condition."""
    return reduce(lambda a, b: a & b, [F.col(c).isin(*v) for c, v in filters.items() if v], F.lit(True))


def cap_between(low: float | None, high: float | None) -> Column:
    parts = [F.col("market_cap") >= low] if low is not None else []
    parts += [F.col("market_cap") <= high] if high is not None else []
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def latest_market_caps(caps: DataFrame) -> DataFrame:
    return latest_per(caps, ["ticker"], [F.desc("date"), F.desc_nulls_last("market_cap")]).select("ticker", "market_cap")


def filtered_tickers(tiers: dict[str, DataFrame | None], filters: dict[str, list], low: float | None = None, high: float | None = None, limit: int | None = None) -> DataFrame:
    """Tickers in order from the first tier that is there and has rows: screener, profiles with the stock list, stock list.

    tiers: ``screener`` (symbol, exchange, sector, industry, country, market_cap); ``profiles`` (ticker and the
    same but for the cap), ``stocks`` (symbol), ``caps`` (ticker, date, market_cap). The stock list knows no
    columns to filter by.
    """
    there = lambda n: tiers.get(n) is not None and not tiers[n].isEmpty()
    if there("screener"):
        rows = tiers["screener"].where(any_of(filters) & cap_between(low, high)).select(F.col("symbol").alias("ticker"))
    elif there("profiles") and there("stocks"):
        rows = tiers["stocks"].select(F.col("symbol").alias("ticker")).join(tiers["profiles"].where(any_of(filters)), "ticker")
        if (low is not None or high is not None) and there("caps"):
            rows = rows.join(latest_market_caps(tiers["caps"]).where(cap_between(low, high)).select("ticker"), "ticker")
        rows = rows.select("ticker")
    elif there("stocks"):
        rows = tiers["stocks"].select(F.col("symbol").alias("ticker"))
    else:
        raise ValueError("no source of tickers is there")
    rows = rows.distinct().orderBy("ticker")
    return rows if limit is None else rows.limit(limit)


def page(df: DataFrame, column: str, start: int, n: int) -> DataFrame:
    """Rows `start` to `start + n` of the distinct values in order."""
    return df.select(column).distinct().orderBy(column).offset(start).limit(n)


def derived_metrics(symbols: DataFrame, prices: DataFrame, shares: DataFrame, screener: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per symbol: mean dollar volume over 30 and 90 calendar days, share of a year's bars, market cap.

    The cap is the close on the day times the latest known shares; what isn't known is null.
    """
    wanted = symbols.select("symbol").distinct()
    day = F.lit(as_of)
    recent = prices.where((F.col("date") <= day) & (F.col("date") > F.add_months(day, -12))).join(wanted, F.col("ticker") == F.col("symbol"), "left_semi")
    dollars = F.col("close") * F.col("volume")
    mean = lambda n: F.avg(F.when(F.col("date") > F.date_sub(day, n), dollars))
    bars = recent.groupBy("ticker").agg(mean(30).alias("avg_dollar_volume_30d"), mean(90).alias("avg_dollar_volume_90d"), F.least(F.round(F.count("close") / 252, 4), F.lit(1.0)).alias("bar_coverage_1y"), F.max(F.when(F.col("date") == day, F.col("close"))).alias("close"))
    known = latest_per(shares.where(F.col("date") <= day), ["ticker"], [F.desc("date"), F.desc_nulls_last("outstanding_shares")]).select("ticker", "outstanding_shares")
    last = latest_per(screener, ["symbol"], [F.desc("as_of_date"), F.asc_nulls_last("exchange"), F.asc_nulls_last("sector")]).select(F.col("symbol").alias("ticker"), "exchange", "sector")
    out = wanted.withColumnRenamed("symbol", "ticker")
    for side in (bars, known, last):
        out = out.join(side, "ticker", "left")
    return out.select(F.col("ticker").alias("symbol"), day.alias("as_of_date"), "avg_dollar_volume_30d", "avg_dollar_volume_90d", "bar_coverage_1y", (F.col("close") * F.col("outstanding_shares")).alias("market_cap"), "exchange", "sector")


def market_caps(wanted: DataFrame, prices: DataFrame, shares: DataFrame) -> DataFrame:
    """wanted (symbol, as_of_date) with market_cap: the close on the day times the latest shares known then, for any set of dates.

    prices (ticker, date, close), one row for a day; shares (ticker, date, outstanding_shares). What isn't known is null.
    """
    known = shares.select(F.col("ticker").alias("symbol"), F.col("date").alias("as_of_date"), "outstanding_shares")
    dated = as_of_join(wanted.select("symbol", "as_of_date").distinct(), known, ["symbol"], "as_of_date", ["outstanding_shares"])
    closes = prices.select(F.col("ticker").alias("symbol"), F.col("date").alias("as_of_date"), "close")
    return dated.join(closes, ["symbol", "as_of_date"], "left").select("symbol", "as_of_date", (F.col("close") * F.col("outstanding_shares")).alias("market_cap"))


def caps_in_range(wanted: DataFrame, caps: DataFrame, low: float | None = None, high: float | None = None, within: int | None = None) -> DataFrame:
    """wanted (ticker, date) whose latest market cap by then lies in the range, with it; caps (ticker, date, market_cap)."""
    return as_of_join(wanted, caps, ["ticker"], "date", ["market_cap"], within).where(F.col("market_cap").isNotNull() & cap_between(low, high))
