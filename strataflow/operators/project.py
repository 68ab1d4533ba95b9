"""Silver projection: contract columns from vendor rows, lineage, row dates and watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import HINT_TYPES, base_hint, camel, coerce, snake, to_number
from ..sources.contracts import Contract


def add_snake_columns(df: DataFrame) -> DataFrame:
    """A snake_case copy of each camelCase column, unless that name is taken."""
    have = set(df.columns)
    fresh = {snake(c): F.col(f"`{c}`") for c in df.columns if snake(c) not in have}
    return df.withColumns(fresh) if fresh else df


def candidates(name: str, api: str | None) -> list[str]:
    """Names under which a contract column may come, the first one found counts."""
    out = [api, snake(api)] if api else []
    return list(dict.fromkeys([*out, name, camel(name), snake(name)]))


def resolve(df: DataFrame, name: str, api: str | None = None) -> Column | None:
    return next((F.col(f"`{c}`") for c in candidates(name, api) if c in df.columns), None)


def resolve_in_map(payload: Column, name: str, api: str | None = None) -> Column:
    """The same for a row that is a map: the first key that is there."""
    return F.coalesce(*[F.element_at(payload, F.lit(c)) for c in candidates(name, api)])


def project(df: DataFrame, contract: Contract, ticker: str | None = None) -> DataFrame:
    """The contract's columns, coerced; a literal ticker takes the place of the column of that name."""
    out = []
    for c in contract.columns:
        found = F.lit(ticker) if ticker is not None and c.name == "ticker" else resolve(df, c.name, c.api)
        value = found if found is not None else F.lit(None).cast(HINT_TYPES[base_hint(c.type)])
        out.append(coerce(value, c.type).alias(c.name))
    return df.select(*out)


def project_map(df: DataFrame, payload: str, contract: Contract, keep: list[str] | None = None, ticker: Column | None = None) -> DataFrame:
    """The contract's columns from a column of maps, beside the columns `keep`."""
    out = [coerce(ticker if ticker is not None and c.name == "ticker" else resolve_in_map(F.col(payload), c.name, c.api), c.type).alias(c.name) for c in contract.columns]
    return df.select(*(keep or []), *out)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Nulls replaced by a column's default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def stamp_lineage(df: DataFrame, file_id: Column, run_id: Column, ingested_at: Column, discriminator: Column | None = None) -> DataFrame:
    lineage = {"bronze_file_id": file_id, "run_id": run_id, "ingested_at": ingested_at}
    return df.withColumns(lineage | ({"discriminator": discriminator} if discriminator is not None else {}))


def default_row_date(df: DataFrame, row_date: str, coverage_to: Column, coverage_from: Column, ingested_at: Column) -> DataFrame:
    """Adds the row date if it isn't there: the file's last date, else its first, else the day it came."""
    return df if row_date in df.columns else df.withColumn(row_date, F.coalesce(coverage_to, coverage_from, ingested_at.cast("date")))


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns are missing: {', '.join(missing)}")
    return df


def recoerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in columns if c in df.columns})


def watermark_filter(df: DataFrame, marks: DataFrame, keys: list[str], row_date: str | None, mark: str = "watermark", mode: str = "per_identity") -> DataFrame:
    """Rows dated after the high-water mark of their keys; all rows where there is no mark.

    mode ``none`` or no row date: nothing is dropped. ``global``: one mark, the largest, for all keys.
    """
    if mode == "none" or row_date is None:
        return df
    if mode == "global":
        marks, keys = marks.agg(F.max(mark).alias("__mark")), []
        joined = df.crossJoin(F.broadcast(marks))  # one row
    else:
        joined = df.join(marks.select(*keys, F.col(mark).alias("__mark")), keys, "left")
    return joined.where(F.col("__mark").isNull() | (F.col(row_date) > F.col("__mark"))).select(*df.columns)


def resolve_contracts(manifest: DataFrame, contracts: DataFrame) -> DataFrame:
    """manifest rows with contract_id and error: exact identity, else without discriminator, else without ticker.

    Both have domain, source, dataset, discriminator and ticker; contracts also contract_id and ticker_scope.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    known = contracts.select("domain", "source", "dataset", blank("discriminator").alias("d"), blank("ticker").alias("t"), "contract_id", "ticker_scope")
    base = ["domain", "source", "dataset"]
    out = manifest.withColumns({"__d": blank("discriminator"), "__t": blank("ticker")})
    found, scopes = [], []
    for i, (d, t) in enumerate(((F.col("__d"), F.col("__t")), (F.lit(""), F.col("__t")), (F.lit(""), F.lit("")))):
        side = known.select(*[F.col(b).alias(f"__{b}{i}") for b in base], F.col("d").alias(f"__d{i}"), F.col("t").alias(f"__t{i}"), F.col("contract_id").alias(f"__c{i}"), F.col("ticker_scope").alias(f"__s{i}"))
        on = [F.col(b) == F.col(f"__{b}{i}") for b in base] + [d == F.col(f"__d{i}"), t == F.col(f"__t{i}")]
        out = out.join(side, on, "left")
        found.append(F.col(f"__c{i}"))
        scopes.append(F.col(f"__s{i}"))
    scope = F.coalesce(*scopes)
    error = F.when(F.coalesce(*found).isNull(), "no contract").when((scope == "per_ticker") & (F.col("__t") == ""), "ticker missing")
    return out.select(*manifest.columns, F.coalesce(*found).alias("contract_id"), error.alias("contract_error"))
