"""As-of join: for each row of one table, the last row of another at or before it, for any set of keys and times.

Both tables are put in one order of (key, time), dealt to ranges, and read forward: inside a range the last row of the
other table is carried on by a window, and what a range ends with is carried to the ranges of the same key after it. So a key of any
length is worked on by as many tasks as it has ranges, and no pair of rows is made that isn't in the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored


def as_of_join(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], within: int | None = None, ties: list[str] | None = None) -> DataFrame:
    """left with `values` of the last row of right that has its `by` and isn't after its `on`; nulls where there is none.

    A row of right counts as a whole, with its nulls. Of rows of one time the last in the order of `ties` (or values, nulls first) counts.
    within: days that a row of right holds on, its own day as the first is 0. Rows with a null key or time find nothing.
    """
    names = left.columns
    rest = [c for c in names if c not in (*by, on)]
    kind = left.schema[on].dataType
    found = F.struct(F.col(on).cast(kind).alias("at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    order = [F.asc_nulls_first(c) for c in ties or values]
    last = Window.partitionBy(*by, on).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, on)])
    one = right.where(whole).withColumn("__after", F.count(F.lit(1)).over(last)).where("__after = 1")  # one for each key and time
    heads = one.select(*by, F.col(on).cast(kind).alias(on), found.alias("__found"), F.lit(0).alias("__side"), F.lit(None).cast(left.select(F.struct(*rest) if rest else F.lit(0)).schema[0].dataType).alias("__row"))
    asked = left.select(*by, on, F.lit(None).cast(heads.schema["__found"].dataType).alias("__found"), F.lit(1).alias("__side"), (F.struct(*rest) if rest else F.lit(0)).alias("__row"))
    parts = max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    line = stored(heads.unionByName(asked).repartitionByRange(parts, *by, on, "__side").withColumn("__part", F.spark_partition_id()), "line")
    inside = Window.partitionBy("__part", *by).orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = line.where("__side = 0").groupBy(*by, "__part").agg(F.max_by("__found", on).alias("__end"))
    # A row for each range and key: what the ranges before end with. Ranges that a key only has rows of left in count too.
    spans = line.groupBy(*by, "__part").agg(F.lit(1).alias("__one")).join(ends, [*by, "__part"], "left")
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    heads_of = spans.withColumn("__head", F.last("__end", ignorenulls=True).over(earlier)).select(*by, "__part", "__head")
    carried = line.withColumn("__last", F.last("__found", ignorenulls=True).over(inside)).where("__side = 1").join(heads_of, [*by, "__part"], "left")
    hit = F.coalesce("__last", "__head")
    if within is not None:
        hit = F.when(F.datediff(F.col(on), hit["at"]) <= within, hit)
    side = carried.withColumn("__hit", F.when(whole, hit))
    return side.select(*[F.col(f"__row.`{c}`").alias(c) if c in rest else F.col(c) for c in names], *[F.col("__hit")[f"v{i}"].alias(v) for i, v in enumerate(values)])
