"""Exact quantiles and percent ranks of groups of any size, many columns at once, without a large group in one task.

A group of up to `fits` rows is gathered once, as an array that all columns are sorted from, or ordered by one window. Larger ones
are never gathered:

* quantiles: counts of values in equal buckets between a column's least and greatest value tell which bucket holds a rank; only
  that bucket's values go on, between their own least and greatest, until they fit or are all equal. A bucket's bounds are
  values, so that every step splits what is left, and ties end it;
* ranks: equal values are counted first, distinct ones are dealt to ranges in order, ranks are counted inside a range and
  offset by the ranges before it.

Which way a group takes changes nothing in its results. Nulls don't count in quantiles, nor do NaN and infinite values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored

#: Rows of a group that one task holds.
FITS = 8192
#: Buckets between the ends of what is left of a column.
BUCKETS = 512


def same(a: DataFrame, b: DataFrame, keys: list[str], b_keys: list[str] | None = None) -> Column:
    """Keys are equal, nulls alike."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[o]) for k, o in zip(keys, b_keys or keys, strict=True)])


def _finite(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when((F.abs(v) < float("inf")) & ~F.isnan(v), v)


def _position(p: Column, n: Column) -> tuple[Column, Column, Column]:
    """A quantile's place among n ordered values from 0, and the ranks below and above it."""
    at = p * (n - 1)
    return at, F.floor(at).cast("bigint"), F.ceil(at).cast("bigint")


def _between(at: Column, low: Column, high: Column, below: Column, above: Column) -> Column:
    return F.when(low == high, below).otherwise((high - at) * below + (at - low) * above)


def group_sizes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): rows of each group, null keys among them; stored."""
    return stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")


def any_large(sizes: DataFrame, fits: int = FITS) -> bool:
    return not sizes.where(F.col("n") > fits).isEmpty()


def known_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def group_quantiles(rows: DataFrame, keys: list[str], columns: list[str], probabilities: list[float], sizes: DataFrame | None = None, fits: int = FITS, beside: list[Column] | None = None) -> DataFrame:
    """keys and `quantiles`, an array for each column of its quantiles, linear between ranks; rows with a null key don't count.

    sizes: the groups' sizes, if the caller has them. beside: other aggregates of the group that are wanted with them. rows are
    read several times.
    """
    known = known_keys(rows, keys)
    sizes = group_sizes(known, keys) if sizes is None else sizes
    if not any_large(sizes, fits):
        return _gathered(known, keys, columns, probabilities, beside or [])
    large = known_keys(sizes, keys).where(F.col("n") > fits).select(*keys)
    rest = _gathered(known.join(large, keys, "left_anti"), keys, columns, probabilities, beside or [])
    many = known.join(large, keys, "left_semi")
    found = _selected(many, keys, columns, probabilities, fits)
    if beside:
        found = many.groupBy(*keys).agg(*beside).join(found, keys)
    return rest.unionByName(found)


def _gathered(rows: DataFrame, keys: list[str], columns: list[str], probabilities: list[float], beside: list[Column]) -> DataFrame:
    """Groups that fit: their rows as one array, sorted for each column."""
    lists = rows.groupBy(*keys).agg(*beside, F.collect_list(F.array(*map(_finite, columns))).alias("__rows"))

    def of(ordered: Column) -> Column:
        out = []
        for p in probabilities:
            at, low, high = _position(F.lit(p), F.size(ordered))
            out.append(_between(at, low, high, F.get(ordered, low.cast("int")), F.get(ordered, high.cast("int"))))
        return F.array(*out)

    column = lambda i: F.sort_array(F.filter(F.transform("__rows", lambda r: F.get(r, i)), lambda v: v.isNotNull()))
    # A transform over an array of one computes its ordered values once.
    each = F.transform(F.sequence(F.lit(0), F.lit(len(columns) - 1)), lambda i: F.get(F.transform(F.array(column(i)), of), F.lit(0)))
    return lists.withColumn("quantiles", each).drop("__rows")


def _selected(rows: DataFrame, keys: list[str], columns: list[str], probabilities: list[float], fits: int) -> DataFrame:
    """Groups of any size, by bucket counts."""
    values = rows.select(*keys, F.posexplode(F.array(*map(_finite, columns))).alias("__f", "__v")).where(F.col("__v").isNotNull())
    of, span = [*keys, "__f"], [*keys, "__f", "__low", "__high"]
    ends = values.groupBy(*of).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    at, below, above = _position(F.col("__p.__p"), F.col("__n"))
    wanted = ends.withColumn("__p", F.explode(F.array(*[F.struct(F.lit(k).alias("__q"), F.lit(p).alias("__p")) for k, p in enumerate(probabilities)])))
    wanted = wanted.select(*span, "__n", F.col("__p.__q").alias("__q"), at.alias("__at"), F.explode(F.array_distinct(F.array(below, above))).alias("__place"))
    # Each rank wanted: its order among the values from low to high, n of them.
    targets = stored(wanted.withColumn("__rank", F.col("__place")), "ranks")
    unsettled = (F.col("__low") < F.col("__high")) & (F.col("__n") > fits)

    def among(spans: DataFrame) -> DataFrame:
        return values.join(spans.select(*span).distinct(), of).where(F.col("__v").between(F.col("__low"), F.col("__high")))

    while not (going_on := targets.where(unsettled)).isEmpty():
        # Halves where a difference would be infinite.
        share = lambda scale: (F.col("__v") / scale - F.col("__low") / scale) / (F.col("__high") / scale - F.col("__low") / scale)
        part = F.when(F.col("__high") - F.col("__low") < float("inf"), share(1)).otherwise(share(2))
        bucket = F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1)).alias("__b")
        counts = among(going_on).groupBy(*span, bucket).agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
        earlier = Window.partitionBy(*span).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("__before", F.coalesce(F.sum("__c").over(earlier), F.lit(0)))
        held = going_on.drop("__n").join(counts, span).where((F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__c")))
        next_ones = held.select(*of, F.col("__least").alias("__low"), F.col("__most").alias("__high"), F.col("__c").alias("__n"), "__q", "__at", "__place", (F.col("__rank") - F.col("__before")).alias("__rank"))
        targets = stored(targets.where(~unsettled).unionByName(next_ones), "ranks")
    fit = among(targets.where("__low < __high")).groupBy(*span).agg(F.sort_array(F.collect_list("__v")).alias("__ordered"))
    found = targets.join(fit, span, "left").withColumn("__value", F.coalesce(F.get("__ordered", F.col("__rank").cast("int")), "__low"))
    one = found.groupBy(*of, "__q", "__at").agg(F.min("__place").alias("__lo"), F.max("__place").alias("__hi"), F.min_by("__value", "__place").alias("__below"), F.max_by("__value", "__place").alias("__above"))
    made = one.select(*of, "__q", _between(F.col("__at"), F.col("__lo"), F.col("__hi"), F.col("__below"), F.col("__above")).alias("__value"))
    of_column = lambda i: F.array(*[F.max(F.when((F.col("__f") == i) & (F.col("__q") == k), F.col("__value"))) for k in range(len(probabilities))])
    quantiles = made.groupBy(*keys).agg(F.array(*[of_column(i) for i in range(len(columns))]).alias("quantiles"))
    # A group whose columns are all null has no values, but is a group.
    return rows.select(*keys).distinct().join(quantiles, keys, "left").withColumn("quantiles", F.coalesce("quantiles", F.array(*[F.array(*[F.lit(None).cast("double")] * len(probabilities))] * len(columns))))


def percent_ranks(rows: DataFrame, keys: list[str], ranks: dict[str, str], sizes: DataFrame | None = None, fits: int = FITS) -> DataFrame:
    """rows with a column for each of ranks (name: value column): PERCENT_RANK within the keys, nulls last; null keys are a key.

    sizes: the groups' sizes, if the caller has them. rows are read several times where a group is large.
    """
    sizes = group_sizes(rows, keys) if sizes is None else sizes
    large = sizes.where(F.col("n") > fits).select(*[F.col(k).alias(f"__{k}") for k in keys])
    plain = lambda df: df.withColumns({name: F.percent_rank().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last(v))) for name, v in ranks.items()})
    if not any_large(sizes, fits):
        return plain(rows)
    is_large = same(rows, large, keys, [f"__{k}" for k in keys])
    out = rows.join(large, is_large, "left_semi")
    for name, value in ranks.items():
        out = _ranked(out, keys, value, name)
    return plain(rows.join(large, is_large, "left_anti")).unionByName(out)


def _ranked(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """rows with percent ranks of groups of any size, by ranges of distinct values."""
    spark = rows.sparkSession
    counts = rows.groupBy(*keys, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    dealt = stored(counts.repartitionByRange(parts, *keys, F.col("__v").asc_nulls_last()).withColumn("__part", F.spark_partition_id()), "values")
    inside = Window.partitionBy("__part", *keys).orderBy(F.asc_nulls_last("__v")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(*keys, "__part").agg(F.sum("__n").alias("__of_part"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = ranges.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__part").alias("__p"), F.coalesce(F.sum("__of_part").over(earlier), F.lit(0)).alias("__start"), F.sum("__of_part").over(Window.partitionBy(*keys)).alias("__total"))
    placed = dealt.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(starts, same(dealt, starts, keys, [f"__{k}" for k in keys]) & (F.col("__part") == F.col("__p")))
    share = F.when(F.col("__total") > 1, (F.col("__start") + F.col("__inside")) / (F.col("__total") - 1)).otherwise(F.lit(0.0))
    side = placed.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__v").alias("__value"), share.alias(name))
    return rows.join(side, same(rows, side, [*keys, value], [*[f"__{k}" for k in keys], "__value"])).select(*rows.columns, name)
