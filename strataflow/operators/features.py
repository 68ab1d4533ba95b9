"""Window features over ordered series: momentum, volatility, rolling statistics, lagged changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Trading rows in a month, a quarter, half a year and a year.
MOMENTUM_ROWS = {"momentum_1m_f": 21, "momentum_3m_f": 63, "momentum_6m_f": 126, "momentum_12m_f": 252}
VOLATILITY_ROWS = 30
YEAR_ROWS = 252


def series(entity: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*entity).orderBy(order)


def trailing(entity: list[str], order: str, rows: int) -> WindowSpec:
    """The row and the rows - 1 before it."""
    return series(entity, order).rowsBetween(1 - rows, 0)


def growth(value: Column, over: WindowSpec, rows: int = 1) -> Column:
    """value / value `rows` rows ago - 1."""
    return value / F.nullif(F.lag(value, rows).over(over), F.lit(0.0)) - 1


def log_return(price: Column, over: WindowSpec) -> Column:
    return F.ln(price / F.nullif(F.lag(price, 1).over(over), F.lit(0.0)))


def slope(value: Column, over: WindowSpec, rows: int) -> Column:
    """Change over `rows` rows, for each row."""
    return (value - F.lag(value, rows).over(over)) / F.lit(float(rows))


def ratio_of_changes(part: Column, whole: Column, over: WindowSpec, rows: int) -> Column:
    """Change of part over the absolute change of whole; null where whole is null or stays."""
    change = F.abs(whole - F.lag(whole, rows).over(over))
    return F.when(change > 0, (part - F.lag(part, rows).over(over)) / change)


def price_features(prices: DataFrame, entity: list[str], order: str, price: str = "adj_close", keep: list[str] | None = None) -> DataFrame:
    """Key columns, and those to keep, with momentum and annualised volatility, for rows that have a price above zero."""
    over = series(entity, order)
    returns = prices.where(F.col(price) > 0).withColumn("__r", log_return(F.col(price), over))
    momentum = [growth(F.col(price), over, n).alias(name) for name, n in MOMENTUM_ROWS.items()]
    risk = F.stddev_samp("__r").over(trailing(entity, order, VOLATILITY_ROWS)) * F.sqrt(F.lit(float(YEAR_ROWS)))
    return returns.select(*entity, order, *(keep or []), *momentum, risk.alias("volatility_30d_f"))


#: Rows that a feature looks back over, and so those after a change that it reaches.
LOOK_BACK = max(*MOMENTUM_ROWS.values(), VOLATILITY_ROWS)


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys of rows that came in, went, or have another value; a key has one row at most."""
    a, b = old.select(*keys, F.struct(value).alias("__a")), new.select(*keys, F.struct(value).alias("__b"))
    return a.join(b, keys, "full").where(~F.col("__a").eqNullSafe(F.col("__b"))).select(*keys)


def renewed_price_features(prices: DataFrame, features: DataFrame, changed: DataFrame, entity: list[str], order: str, price: str = "adj_close") -> DataFrame:
    """features after the rows of prices named by `changed` (entity and order) came in, went or were corrected.

    prices are those after the change. Each entity's slice goes from LOOK_BACK rows before its first change to LOOK_BACK rows
    after its last one; features are computed over it, and take the places of those from the first change on. Entities
    without a change aren't touched, and their prices aren't shuffled where the changed ones fit a broadcast.
    """
    spans = changed.groupBy(*entity).agg(F.min(order).alias("__first"), F.max(order).alias("__last"))
    every = Window.partitionBy(*entity)
    place = prices.where(F.col(price) > 0).join(spans, entity).withColumns({
        "__n": F.row_number().over(series(entity, order)), "__before": F.count_if(F.col(order) < F.col("__first")).over(every), "__upto": F.count_if(F.col(order) <= F.col("__last")).over(every),
    })
    piece = place.where((F.col("__n") > F.col("__before") - LOOK_BACK) & (F.col("__n") <= F.col("__upto") + LOOK_BACK))
    made = price_features(piece.select(*entity, order, price, "__first", "__last"), entity, order, price, keep=["__first", "__last"]).where(F.col(order) >= F.col("__first"))
    ends = spans.join(made.groupBy(*entity).agg(F.max(order).alias("__end")), entity, "left").withColumn("__end", F.greatest("__last", "__end"))
    rest = features.join(ends, entity, "left").where(F.col("__first").isNull() | (F.col(order) < F.col("__first")) | (F.col(order) > F.col("__end")))
    return rest.select(*features.columns).unionByName(made.select(*features.columns))


def refresh_features(facts: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """facts with the features' columns renewed where the features have the key, and as they were elsewhere."""
    names = [c for c in features.columns if c not in keys]
    side = features.select(*keys, *[F.col(c).alias(f"__{c}") for c in names], F.lit(True).alias("__hit"))
    old = {c: F.col(c) if c in facts.columns else F.lit(None) for c in names}
    joined = facts.join(side, keys, "left")
    return joined.select(*[c for c in facts.columns if c not in names], *[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(old[c]).alias(c) for c in names])
