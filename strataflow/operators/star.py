"""Star schema: symbol unions, dimensions with code lookups, facts from required and optional sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_sk
from .upsert import allocate_sk, fill_nulls, latest_per

def symbol_union(sources: list[tuple[DataFrame | None, dict[str, Column]]], columns: list[str], key: str = "symbol") -> DataFrame:
    """One row per symbol over all sources that are there; on a tie of symbols the earlier source counts.

    Each source comes with expressions for the columns it has; the rest are null.
    """
    rows = []
    for rank, (df, have) in enumerate(sources):
        if df is not None:
            rows.append(df.select(*[have[c].cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns], F.lit(rank).alias("__rank")))
    if not rows:
        raise ValueError("no source is there")
    every = reduce(DataFrame.unionByName, rows).where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()
    return latest_per(every, [key], ["__rank", *[F.asc_nulls_last(c) for c in columns]]).drop("__rank")


def lookup_codes(df: DataFrame, lookups: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """df with each surrogate key: {code column of df: (dimension, its code column, its key column)}; unknown codes give null."""
    for code, (dim, dim_code, sk) in lookups.items():
        side = dim.select(F.col(dim_code).alias(f"__{code}"), F.col(sk))
        df = df.join(side, F.col(code) == F.col(f"__{code}"), "left").drop(f"__{code}")
    return df


def build_dim(existing: DataFrame, sources: DataFrame, natural_key: list[str], sk: str, backfill: list[str]) -> DataFrame:
    """The dimension after a build: old rows keep key and values, null attributes are filled, new keys come in."""
    filled = fill_nulls(existing, sources, natural_key, backfill)
    keys = allocate_sk(existing, sources, natural_key, sk)
    fresh = sources.join(existing.select(*natural_key), natural_key, "left_anti").join(keys, natural_key)
    return filled.unionByName(fresh.select(*existing.columns))


def fact_eod(prices: DataFrame, instruments: DataFrame, measures: list[str]) -> DataFrame:
    """Prices of known symbols by instrument and day."""
    return prices.join(instruments.select("symbol", "instrument_sk"), "symbol").select("instrument_sk", date_sk(F.col("date")).alias("date_sk"), *measures)


def fact_from_statements(required: DataFrame, optional: list[tuple[DataFrame | None, list[tuple[str, str]]]], keys: list[str], instruments: DataFrame | None = None) -> DataFrame:
    """required ⟕ each optional source on keys; the columns of a source that is absent are null.

    Each optional source comes with (column, type) pairs; of its rows for a key there may be one.
    """
    out = required
    for df, columns in optional:
        if df is None:
            out = out.withColumns({c: F.lit(None).cast(t) for c, t in columns})
        else:
            out = out.join(df.select(*keys, *[F.col(c).cast(t).alias(c) for c, t in columns]), keys, "left")
    if instruments is not None:
        out = out.join(instruments.select("symbol", "instrument_sk"), "symbol").drop("symbol")
    return out


def evolve(facts: DataFrame, add: dict[str, str] | None = None, drop: list[str] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """facts in a newer shape, on read: columns added as nulls, dropped and renamed."""
    out = facts.drop(*(drop or [])).withColumnsRenamed(rename or {})
    return out.withColumns({c: F.lit(None).cast(t) for c, t in (add or {}).items() if c not in out.columns})


def resolve_instruments(symbols: DataFrame, instruments: DataFrame, types: DataFrame, kind: str) -> DataFrame:
    """(symbol, instrument_sk) of the symbols found, upper-cased, among instruments of a type."""
    of_kind = instruments.join(types.where(F.col("instrument_type") == kind).select("instrument_type_sk"), "instrument_type_sk")
    wanted = symbols.select(F.upper(F.trim("symbol")).alias("symbol")).distinct()
    return of_kind.select(F.upper("symbol").alias("symbol"), "instrument_sk").join(wanted, "symbol")


def tickers_on_exchanges(profiles: DataFrame, instruments: DataFrame, exchanges: list[str], limit: int | None = None) -> DataFrame:
    rows = profiles.where(F.upper("exchange").isin(*[e.upper() for e in exchanges])).join(instruments.select("symbol", "instrument_sk"), "symbol").select("symbol", "instrument_sk").orderBy("symbol")
    return rows if limit is None else rows.limit(limit)


def existing_instruments(symbols: DataFrame, instruments: DataFrame) -> DataFrame:
    return symbols.join(instruments.select("symbol"), "symbol", "left_semi")


def merge_discovered(target: DataFrame, source: DataFrame, forex: str = "forex") -> DataFrame:
    """The unified instrument table after discovery: nulls of known symbols are filled, new symbols come in, and
    six-letter forex symbols are split into their currencies."""
    from ..functions.coerce import forex_pair
    from .upsert import upsert

    first, second = forex_pair(F.col("symbol"))
    is_pair = F.col("instrument_type") == forex
    split = source.withColumns({"base_currency": F.when(is_pair, first), "quote_currency": F.when(is_pair, second)})
    one = latest_per(split, ["symbol", "instrument_type"], [F.asc_nulls_last(c) for c in split.columns if c not in ("symbol", "instrument_type")])
    return upsert(target, one, ["symbol", "instrument_type"], "coalesce")
