"""Incremental promotion of landed Bronze files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.key_filter import add_keys, maybe_there
from ..operators.project import project_map, watermark_filter
from ..operators.upsert import new_rows, split_null_keys
from ..sources.bronze import ENVELOPE, can_promote, rejection
from ..sources.contracts import Contract
from ..sources.storage import current, exists, refresh, stored, update


def silver_batch(files: DataFrame, contract: Contract) -> DataFrame:
    """Typed rows of a batch of files that may be promoted, with lineage; one row per key, the latest file's.

    A contract's `reshape` gets the payload rows (`row`, a map, beside bronze_file_id, run_id, ingested_at and __pos) before
    they are typed, and returns rows of the same columns: fewer, more or others.
    """
    from pyspark.sql import Window

    good = files.where(rejection(files).isNull() & can_promote()).select(F.col("request.file_id").alias("bronze_file_id"), F.col("request.run_id").alias("run_id"), F.col("now").try_cast("timestamp").alias("ingested_at"), F.posexplode("content").alias("__pos", "row"))
    if contract.reshape is not None:
        good = contract.reshape(good)
    typed = project_map(good, "row", contract, keep=["bronze_file_id", "run_id", "ingested_at", "__pos"])
    last = Window.partitionBy(*contract.key_cols).orderBy(F.desc_nulls_last("ingested_at"), F.desc("bronze_file_id"), F.desc("__pos"))
    names = [c.name for c in contract.columns] + ["bronze_file_id", "run_id", "ingested_at"]
    return typed.withColumn("__n", F.row_number().over(last)).where("__n = 1").select(*names)


def promote_batch(spark: SparkSession, files: DataFrame, contract: Contract, target: str, watermark: str | None = None, partition: str | None = None, on_batch: Callable[[DataFrame], None] | None = None, mark_keys: tuple[str, ...] = ()) -> None:
    """Appends a batch's new keys to the Silver folder `target`; rows with a null key go to `target`_errors.

    The files are read once. Doing a batch again appends nothing to either. `partition` is ``year`` or ``month`` of the row
    date. Beside the target are

    * `target`_keys, a filter of the keys that are there (:mod:`..operators.key_filter`), by year where the row date is part of the key:
      the target is read only for keys that the filter has, in their years;
    * `target`_marks, with `watermark`, a row-date column: the largest date promoted for each value of `mark_keys`, or
      in all. Rows not after their mark are dropped. Marks move on after the rows are written: a batch that fails between is done
      again under the old marks, and finds its keys there.

    Either is made from the target if the target is older than it.
    """
    keys, date = list(contract.key_cols), contract.row_date_col
    batch = stored(silver_batch(files, contract), "batch")
    rows, lost = split_null_keys(batch, keys)
    foldered = bool(partition and date)
    folder = F.year(date) if foldered and date in keys else F.lit(0)
    there = exists(spark, target)
    if watermark and there:
        rows = watermark_filter(rows, _marks(spark, target, watermark, mark_keys), list(mark_keys), watermark, mode="per_identity" if mark_keys else "global")
    due = rows  # those of a failed batch that are there already also move the marks on
    if there:
        rows = _unseen(rows, target, keys, folder, foldered and date in keys)
    rows = stored(rows, "fresh")
    if on_batch:
        on_batch(rows)
    add_keys(rows, f"{target}_keys", keys, folder)
    parts: list[str] = []
    out = rows
    if foldered:
        out, parts = out.withColumn("row_year", F.year(date)), ["row_year"]
        if partition == "month":
            out, parts = out.withColumn("row_month", F.month(date)), [*parts, "row_month"]
    writer = out.write.mode("append")
    (writer.partitionBy(*parts) if parts else writer).parquet(target)
    if watermark:
        update(spark, f"{target}_marks", lambda old, noted: (_largest(due, watermark, mark_keys, old), noted))
    errors = f"{target}_errors"
    if exists(spark, errors):  # whole rows with their file are compared, nulls alike
        lost = lost.subtract(spark.read.parquet(errors).select(*lost.columns).join(lost.select("bronze_file_id").distinct(), "bronze_file_id", "left_semi").select(*lost.columns))
    lost.write.mode("append").parquet(errors)


def _largest(rows: DataFrame, date: str, keys: tuple[str, ...], old: DataFrame | None = None) -> DataFrame:
    """(keys, watermark): the largest date of the rows and of older marks."""
    marks = rows.groupBy(*keys).agg(F.max(date).alias("watermark"))
    return marks if old is None else marks.unionByName(old).groupBy(*keys).agg(F.max("watermark").alias("watermark"))


def _marks(spark: SparkSession, target: str, date: str, keys: tuple[str, ...]) -> DataFrame:
    path = f"{target}_marks"
    if not exists(spark, path):
        return refresh(_largest(spark.read.parquet(target), date, keys), path)
    return current(spark, path)


def _unseen(rows: DataFrame, target: str, keys: list[str], folder: Column, by_year: bool) -> DataFrame:
    """Rows whose keys the target lacks."""
    spark, path = rows.sparkSession, f"{target}_keys"
    if not exists(spark, path):
        add_keys(spark.read.parquet(target), path, keys, folder)
    hits = stored(maybe_there(rows, path, keys, folder), "hits")
    span = hits.agg(F.min("folder").alias("a"), F.max("folder").alias("b")).first()
    if span["a"] is None:
        return rows
    old = spark.read.parquet(target)
    if by_year:
        old = old.where(F.col("row_year").between(span["a"], span["b"]))
    return new_rows(rows, old.select(*keys).join(hits.select(*keys), keys, "left_semi"), keys)


def promote_stream(spark: SparkSession, landing: str, contract: Contract, target: str, checkpoint: str, max_files: int | None = None, lines: bool = False, **options) -> StreamingQuery:
    """Starts a run over all files not yet seen, in batches of at most `max_files`, and ends when there are none.

    A file that can't be read, or may not be promoted, is left out of its batch and stops nothing.
    """
    reader = spark.readStream.schema(ENVELOPE).option("multiLine", not lines).option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.json(landing)
        .writeStream.foreachBatch(lambda files, _: promote_batch(files.sparkSession, files, contract, target, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
