"""Bronze: scans of landed payload files, acceptance gates, manifest rows, recovery.

A payload file is one JSON document: the request, what the transport said, and ``content``, a list of objects.
Values of the objects are read as text and typed by the contract later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = (
    "request struct<domain:string,source:string,dataset:string,discriminator:string,ticker:string,run_id:string,file_id:string,date_key:string,from_date:string,to_date:string,allow_empty:boolean>,"
    " now string, elapsed_microseconds bigint, headers string, status_code int, reason string, content array<map<string,string>>, error string, _corrupt_record string"
)


def read_bronze(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per document under a folder, with its path; what is no such document has _corrupt_record.

    lines: files hold a document on each line, as write_bronze leaves them, else one document each.
    """
    return spark.read.schema(ENVELOPE).option("multiLine", not lines).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", True).json(path).withColumn("bronze_filename", F.col("_metadata.file_path"))


def payload_rows(files: DataFrame) -> DataFrame:
    """One row per object of each file's content, beside the file's columns; files without content give none."""
    return files.where("content IS NOT NULL").withColumn("row", F.explode("content"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV payload with a header, all text."""
    return spark.read.option("header", True).option("multiLine", True).option("inferSchema", False).csv(path)


def unwrap(payload: Column, key: str) -> Column:
    """The list of objects under a key of a JSON text; empty if it isn't there."""
    return F.coalesce(F.from_json(F.get_json_object(payload, f"$.{key}"), "array<map<string,string>>"), F.array().cast("array<map<string,string>>"))


def wrap_values(values: Column) -> Column:
    """A list of texts as objects with the key ``value``."""
    return F.transform(values, lambda s: F.create_map(F.lit("value"), s))


def attributes(files: DataFrame, names: list[str]) -> DataFrame:
    """The named attributes of all payload rows as text; rows that lack one are left out."""
    rows = payload_rows(files).select(*[F.element_at("row", F.lit(n)).alias(n) for n in names])
    return rows.dropna("any")


def file_date(path: Column) -> Column:
    """The ISO date that ends a file's name."""
    return F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})\.[A-Za-z]+$", 1).try_cast("date")


def boundary_dates(content: Column, date_key: Column) -> tuple[Column, Column]:
    """Smallest and largest date at a key of the content; null where there is none."""
    dates = F.transform(content, lambda m: F.element_at(m, date_key).try_cast("date"))
    return F.array_min(dates), F.array_max(dates)


def payload_hash(content: Column) -> Column:
    """SHA-256 of the content in a canonical form: keys in order, no blanks."""
    ordered = F.transform(content, lambda m: F.map_from_entries(F.array_sort(F.map_entries(m))))
    return F.sha2(F.to_json(ordered), 256)


def rejection(files: DataFrame) -> Column:
    """Why a file is no valid Bronze, or null."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    return (
        F.when(F.col("_corrupt_record").isNotNull(), "no payload document").when(F.col("request").isNull(), "request missing").when(blank("now"), "now missing")
        .when(blank("headers"), "headers missing").when(F.col("status_code").isNull(), "status missing").when(blank("reason"), "reason missing")
        .when(F.col("elapsed_microseconds").isNull() | (F.col("elapsed_microseconds") < 0), "elapsed invalid").when(F.col("content").isNull(), "content is no list of objects")
    )


def can_promote() -> Column:
    """Status 200, no error, and content unless the request allows none."""
    filled = (F.size("content") > 0) | F.coalesce("request.allow_empty", F.lit(False))
    return F.coalesce((F.col("status_code") == 200) & (F.coalesce("error", F.lit("")) == "") & F.col("content").isNotNull() & filled, F.lit(False))


def bronze_manifest(files: DataFrame, today: Column | None = None) -> DataFrame:
    """Manifest rows of scanned files; a date that the content lacks is taken as today."""
    first, last = boundary_dates(F.col("content"), F.coalesce("request.date_key", F.lit("date")))
    day = today if today is not None else F.current_date()
    start = F.col("now").try_cast("timestamp")
    reason = F.coalesce(rejection(files), F.nullif(F.col("error"), F.lit("")))
    return files.select(
        *[F.col(f"request.{c}").alias(c) for c in ("run_id", "file_id", "domain", "source", "dataset", "discriminator", "ticker")], "bronze_filename", reason.alias("bronze_error"),
        F.size("content").cast("bigint").alias("bronze_rows"), F.coalesce(first, day).alias("bronze_from_date"), F.coalesce(last, day).alias("bronze_to_date"),
        start.alias("bronze_injest_start_time"), F.expr("timestampadd(MICROSECOND, elapsed_microseconds, try_cast(now AS timestamp))").alias("bronze_injest_end_time"),
        (can_promote() & rejection(files).isNull()).alias("bronze_can_promote"), payload_hash(F.col("content")).alias("bronze_payload_hash"),
    )


def recover_manifest(spark: SparkSession, manifest: DataFrame, path: str, lines: bool = False, today: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifest, one row with the number of files that could not be read): rebuilt from all files if it is empty."""
    if not manifest.isEmpty():
        return manifest, spark.createDataFrame([(0,)], "unreadable bigint")
    files = read_bronze(spark, path, lines)
    readable = F.col("_corrupt_record").isNull() & F.col("request").isNotNull()
    return bronze_manifest(files.where(readable), today), files.agg(F.count_if(~readable).alias("unreadable"), F.count("now").alias("dated")).drop("dated")


def write_bronze(files: DataFrame, path: str) -> None:
    """Appends payload documents by domain, source and dataset."""
    keys = ("domain", "source", "dataset")
    files.withColumns({k: F.col(f"request.{k}") for k in keys}).write.mode("append").partitionBy(*keys).json(path)


def latest_date(files: DataFrame) -> DataFrame:
    """The largest date at each request's date key over all files."""
    _, last = boundary_dates(F.col("content"), F.coalesce("request.date_key", F.lit("date")))
    return files.agg(F.max(last).alias("latest"))
