"""Keyed writes: keep-last, upserts, insert-if-new, null back-fill and stable surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored


def latest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which must be total for a stable result."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are all there, the others): null keys match nothing, so they would be inserted again and again."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.where(~missing), df.where(missing)


def new_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks."""
    return source.join(target.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], mode: str = "upsert", order: list[Column] | None = None) -> DataFrame:
    """target after the write, with target's columns.

    mode ``upsert``: source rows replace target rows of their key. ``insert_only``: only new keys come in.
    ``coalesce``: new keys come in, and nulls of old rows are filled from the source. A source with several
    rows for a key needs `order`; its first one counts.
    """
    if order:
        source = latest_per(source, keys, order)
    source = source.select(*target.columns)
    if mode == "upsert":
        return target.join(source.select(*keys), keys, "left_anti").select(*target.columns).unionByName(source)
    if mode == "insert_only":
        return target.unionByName(new_rows(source, target, keys).select(*target.columns))
    if mode == "coalesce":
        rest = [c for c in target.columns if c not in keys]
        renamed = source.select(*keys, *[F.col(c).alias(f"__{c}") for c in rest])
        return target.join(renamed, keys, "full").select(*[F.col(c) if c in keys else F.coalesce(c, f"__{c}").alias(c) for c in target.columns])
    raise ValueError(f"no such mode: {mode}")


def fill_nulls(target: DataFrame, richest: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """target with nulls of `columns` filled from the source's richest row for each key (most non-null columns)."""
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
    ranked = latest_per(richest.withColumn("__filled", filled), keys, [F.desc("__filled"), *[F.asc_nulls_last(c) for c in columns]])
    source = ranked.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    return target.join(source, keys, "left").select(*[F.coalesce(c, f"__{c}").alias(c) if c in columns else F.col(c) for c in target.columns])


def allocate_sk(existing: DataFrame, candidates: DataFrame, natural_key: list[str], sk: str) -> DataFrame:
    """(natural key, sk) of all keys: old ones as they are, new ones counted on from the largest, in key order.

    New keys are range-partitioned and numbered inside their range; ranges start where the earlier ones end, so
    no task sees all keys.
    """
    fresh = new_rows(candidates.select(*natural_key).distinct(), existing, natural_key)
    parts = max(1, int(fresh.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    ranges = stored(fresh.repartitionByRange(parts, *natural_key).select(*natural_key, F.spark_partition_id().alias("__part")), "keys")
    counts = ranges.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    top = existing.agg(F.coalesce(F.max(sk).cast("long"), F.lit(0).cast("long")).alias("__top"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*natural_key))
    numbered = ranges.withColumn("__i", inside).join(F.broadcast(starts), "__part").crossJoin(F.broadcast(top))
    kind = existing.schema[sk].dataType
    added = numbered.select(*natural_key, (F.col("__top") + F.col("__start") + F.col("__i")).cast(kind).alias(sk))
    return existing.select(*natural_key, sk).unionByName(added)
