"""Which keys a table may hold, kept beside it as bitmaps by folder: asked before the table itself is read.

A key sets HASHES bits of its folder's bitmap, in blocks of 4 KB that Spark's bitmap aggregates make. Each batch appends the blocks that
it sets, and blocks of a place are read as one, so adding needs no lock, adding twice changes nothing, and a batch that
fails leaves bits that only cost a look into the table. A key without all its bits is not in the table; one with all of
them may be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a folder, 8 MB once all blocks are there, and bits that a key sets.
BITS = 1 << 26
HASHES = 4
_BLOCK = 8 * 4096


def _bits(rows: DataFrame, keys: list[str], folder: Column, bits: int) -> DataFrame:
    places = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.pmod(F.xxhash64(i, *keys), F.lit(bits)))
    spread = rows.select(*keys, folder.cast("int").alias("__folder"), F.posexplode(places).alias("__hash", "__bit"))
    return spread.select(*keys, "__folder", "__hash", F.expr(f"CAST(__bit div {_BLOCK} AS INT)").alias("__block"), (F.col("__bit") % _BLOCK).alias("__at"))


def add_keys(rows: DataFrame, path: str, keys: list[str], folder: Column, bits: int = BITS) -> None:
    """Sets the bits of the rows' keys. To be done before the rows are written, so that none is there unmarked."""
    blocks = _bits(rows, keys, folder, bits).groupBy("__folder", "__block").agg(F.bitmap_construct_agg("__at").alias("bits"))
    blocks.select(F.col("__folder").alias("folder"), F.col("__block").alias("block"), "bits").write.mode("append").partitionBy("folder").parquet(path)


def maybe_there(rows: DataFrame, path: str, keys: list[str], folder: Column, bits: int = BITS) -> DataFrame:
    """(keys, folder) of the rows whose keys the table may hold; reads blocks of the rows' folders only."""
    spark = rows.sparkSession
    span = rows.agg(F.min(folder).alias("a"), F.max(folder).alias("b")).first()
    asked = _bits(rows.select(*keys, folder.alias("__f")).distinct(), keys, F.col("__f"), bits)
    blocks = spark.read.schema("block int, bits binary, folder int").parquet(path)
    blocks = blocks.where(F.col("folder").between(span["a"], span["b"])) if span["a"] is not None else blocks.where("false")
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(__at div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("CAST(__at % 8 AS INT)")
    hit = asked.join(blocks, (F.col("__folder") == F.col("folder")) & (F.col("__block") == F.col("block"))).where(F.call_function("shiftright", byte, is_set).bitwiseAND(1) == 1)
    return hit.groupBy(*keys, "folder").agg(F.count_distinct("__hash").alias("__n")).where(F.col("__n") == HASHES).drop("__n")
