"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a weight and a size (the words of its documents). A source's target is its share, by weight,
of all sizes; no target is above ``most`` times its source's size, the excess being shared again by weight. A
document should then be taken ``target / source size`` times: the whole part is taken at once, and the
fractional parts are rounded by the pivotal method. Two fractional documents meet, and words move from one to
the other, at random and without bias, until one of them has a whole number of copies. The other one goes on
to meet the next. Words, not probabilities, move, so a source's taken words stay what they were and the last
document left of a source is the only error.

Meeting happens in a reduction tree: documents are dealt to blocks of about ``block`` by a hash of the id,
each block leaves at most one fractional document, and these are blocks again at the next level until one for
each source is left. A source with a third of all rows only has more blocks. Random draws are hashes of ids
and seed, so reruns agree.

DataFrame functions only. The table of sources is small (a row for each source) and is ranked in one window.

Edge cases: a null text has size 0 and is never taken; a null source is a source of its own, last in order;
rows that repeat an id, source and text are one unit, whose copies are dealt to them evenly, so that they round apart by one
copy at most; rows that share only their id, null or not, are units of their own; an empty table gives an empty result; other columns are kept by :func:`mix_documents`,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_CLASS, blank_if_null, named, stored, unused

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
BLOCK = 128
SEED = 2024
#: Fractions closer to a whole number than this are taken as whole.
TINY = 1e-9


def n_words(text: str) -> Column:
    return F.size(F.regexp_extract_all(blank_if_null(text), F.lit(WORD_CLASS), F.lit(0))).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target), from rows with source and size.

    Sources are filled in the order of how soon they reach their limit: with the first k at their limit, the
    rest share what is left by weight, and k is the first for which the next one stays below its own limit.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    soonest = Window.orderBy((F.col("limit") / F.col("weight")), F.asc_nulls_last("source"))
    before, everything = soonest.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    filled = (
        ranked.withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
        .withColumn("full_limit", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("free_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full_limit")) / F.col("free_weight"))
        .withColumn("open_level", F.when(F.col("limit") / F.col("weight") >= F.col("level"), F.col("level")))
        .withColumn("level", F.min_by("open_level", F.when(F.col("open_level").isNotNull(), F.col("limit") / F.col("weight"))).over(everything))
    )
    return filled.select("source", "source_size", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target"))


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) that follows from the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _meet(level: int, seed: int) -> Column:
    """Fold of one block's array `docs`: the documents in order, one of them fractional at a time."""
    one = lambda c: F.struct(c["id"].alias("id"), c["size"].alias("size"), c["part"].alias("part"))

    def step(acc: Column, x: Column) -> Column:
        now = acc["open"]
        up = F.least((1.0 - now["part"]) * now["size"], x["part"] * x["size"])
        down = F.least(now["part"] * now["size"], (1.0 - x["part"]) * x["size"])
        rise = _draw(F.lit(seed), F.lit(level), F.col("source"), now["id"], x["id"], now["size"], x["size"]) * (up + down) < down
        moved = F.when(rise, up).otherwise(-down)
        a, b = now["part"] + moved / now["size"], x["part"] - moved / x["size"]
        whole = lambda p: F.when(p < TINY, F.lit(0.0)).when(p > 1 - TINY, F.lit(1.0)).otherwise(p)
        a, b = whole(a), whole(b)
        first = F.struct(now["id"].alias("id"), now["size"].alias("size"), a.alias("part"))
        second = F.struct(x["id"].alias("id"), x["size"].alias("size"), b.alias("part"))
        settled = (a == 0) | (a == 1)
        return F.struct(F.when(settled, second).otherwise(first).alias("open"), F.concat(acc["done"], F.array(F.when(settled, first).otherwise(second))).alias("done"))

    start = F.struct(one(F.col("docs")[0]).alias("open"), F.filter("docs", lambda _: F.lit(False)).alias("done"))
    rest = F.slice("docs", 2, F.size("docs"))
    return F.aggregate(rest, start, step, lambda acc: F.concat(acc["done"], F.array(acc["open"])))


def round_fractions(units: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """units (source, id, size, part) with part between 0 and 1 -> (source, id, size, take 0 or 1).

    Sums of size * part are kept for each source but for its last document.
    """
    now = stored(units.select("source", "id", "size", "part").where((F.col("part") > 0) & (F.col("size") > 0)), "fractions")
    out: list[DataFrame] = []
    counts = now.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    level, largest = 0, counts.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        blocks = F.greatest(F.ceil(F.col("n") / block), F.lit(1)).cast("long")
        where = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("u.id"), F.col("u.size")), F.col("blocks"))
        dealt = now.alias("u").join(counts.select(F.col("source").alias("s"), blocks.alias("blocks")).alias("c"), F.col("u.source").eqNullSafe(F.col("c.s")))
        grouped = dealt.select("u.*", where.alias("block")).groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "size", "part"))).alias("docs"))
        met = grouped.select("source", F.explode(_meet(level, seed)).alias("d")).select("source", "d.id", "d.size", "d.part")
        met = stored(met, "pivots")
        out.append(met.where("part = 0 OR part = 1"))
        now = met.where("part > 0 AND part < 1")
        counts = now.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        level += 1
        largest = counts.agg(F.max("n")).first()[0] or 0
    last = now.withColumn("part", (_draw(F.lit(seed), F.lit(-1), F.col("source"), F.col("id"), F.col("size")) < F.col("part")).cast("double"))
    for x in out:
        last = last.union(x)
    return last.select("source", "id", "size", F.col("part").cast("long").alias("take"))


def plan_mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Rows (id, source, size) -> one row per distinct (id, source, size): rows, source_size, target and copies of all of them."""
    targets = source_targets(sized, weights, most)
    units = sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)) * F.col("rows")
    floor = F.floor(F.col("rate") + TINY)
    wanted = (
        units.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("rate", rate)
        .withColumn("whole", F.when(F.col("size") > 0, floor).otherwise(F.lit(0)).cast("long"))
        .withColumn("part", F.greatest(F.lit(0.0), F.col("rate") - floor))
        .withColumn("part", F.when(F.col("part") < TINY, 0.0).otherwise(F.col("part")))
    )
    rounded = round_fractions(wanted.select("source", "id", "size", "part"), seed=seed)
    taken = rounded.where("take = 1").select(F.col("source").alias("s2"), F.col("id").alias("i2"), F.col("size").alias("z2"))
    same = F.col("source").eqNullSafe(F.col("s2")) & F.col("id").eqNullSafe(F.col("i2")) & (F.col("size") == F.col("z2"))
    return wanted.join(taken, same, "left").select("id", "source", "size", "rows", "source_size", "target", (F.col("whole") + F.col("z2").isNotNull().cast("long")).alias("copies"))


def _dealt(rows: DataFrame, unit: list[str], n: str, of: str, part: str) -> DataFrame:
    """rows, of which `of` are alike in `unit`, with their unit's n copies dealt to them: some get one more than others.

    Rows are counted inside the partitions that they were stored in, and partitions are offset by those before them.
    """
    inside, before, row = unused("inside", "before", "row", taken=rows.columns)
    own = stored(rows.withColumn(part, F.spark_partition_id()), "repeats")
    counts = own.groupBy(*map(named, unit), part).agg(F.count(F.lit(1)).alias(inside))
    earlier = Window.partitionBy(*map(named, unit)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[named(c).alias(f"{row}{i}") for i, c in enumerate(unit)], F.col(part).alias(row), F.coalesce(F.sum(inside).over(earlier), F.lit(0)).alias(before))
    met = own.join(starts, reduce(lambda a, b: a & b, [named(c).eqNullSafe(F.col(f"{row}{i}")) for i, c in enumerate(unit)]) & (own[part] == starts[row]))
    place = F.col(before) + F.row_number().over(Window.partitionBy(*map(named, unit), part).orderBy(F.lit(1)))
    copies = F.floor(F.col(n) / F.col(of)) + (place <= F.col(n) % F.col(of)).cast("long")
    return met.withColumn(n, copies.cast("long")).select(*map(named, rows.columns))


def _unit(id_col: str, text_col: str) -> Column:
    """What tells documents apart: a digest of id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(named(id_col).cast("string"), F.lit("")), F.when(named(id_col).isNull(), "-").otherwise("+"), blank_if_null(text_col))))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], most: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(sizes of all rows, plan of all units)."""
    sized = docs.select(_unit(id_col, text_col).alias("id"), named(source_col).alias("source"), n_words(text_col).alias("size"), named(id_col).alias("doc"))
    sized = stored(sized, "sizes")
    return sized, stored(plan_mix(sized.drop("doc"), weights, most, seed), "plan")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """One row per row of docs: id, size, source_size, target, taken (words, repeats counted), copies."""
    sized, plan = _planned(docs, id_col, text_col, source_col, weights, most, seed)

    def of(planned: DataFrame) -> DataFrame:
        planned = planned.select(F.col("id").alias("i"), F.col("source").alias("s"), "rows", "source_size", "target", "copies")
        return sized.join(planned, (F.col("id") == F.col("i")) & F.col("source").eqNullSafe(F.col("s"))).drop("i", "s")

    joined = of(plan.where("rows = 1"))
    if not plan.where("rows > 1").isEmpty():
        joined = joined.unionByName(_dealt(of(plan.where("rows > 1")), ["id", "source"], "copies", "rows", "part"))
    return joined.select(F.col("doc").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """docs with every row repeated as often as the mix takes it; rows taken no time go."""
    _, plan = _planned(docs, id_col, text_col, source_col, weights, most, seed)
    unit, of, n, alike, copy, part = unused("unit", "of", "copies", "rows", "copy", "part", taken=docs.columns)
    own = docs.withColumn(unit, _unit(id_col, text_col))

    def met(planned: DataFrame) -> DataFrame:
        taken = planned.where("copies > 0").select(F.col("id").alias(unit), F.col("source").alias(of), F.col("copies").alias(n), F.col("rows").alias(alike))
        return own.join(taken, (own[unit] == taken[unit]) & named(source_col).eqNullSafe(F.col(of))).drop(taken[unit])

    joined = met(plan.where("rows = 1"))
    if not plan.where("rows > 1").isEmpty():
        joined = joined.unionByName(_dealt(met(plan.where("rows > 1")), [unit, of], n, alike, part).where(F.col(n) > 0))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).select(*[named(c) for c in docs.columns])
