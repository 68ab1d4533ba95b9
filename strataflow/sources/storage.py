"""The folder that driver and executors share, tables written there to cut a plan's lineage, and versioned tables.

A versioned table is a folder of versions, each a table of its own, and a log of numbered files that name them. A version counts once
its number is in the log, and only one writer can create a number: the next one retries from the version that came first.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of our own if driver and executors are one machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: on a cluster it must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strataflow-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/strataflow/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Files


def _file(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them, whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path; nothing below it is listed."""
    fs, p = _file(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, in order; none if there is no folder."""
    fs, p = _file(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _claimed_by_rename(spark: SparkSession, draft, target) -> None:
    """Moves draft to target unless that is there: one step of the file system, as in HDFS."""
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(draft, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))


def _claimed_by_link(spark: SparkSession, draft, target) -> None:
    """The same for a local disk, where a rename would replace the target."""
    to = spark.sparkContext._jvm.java.nio.file.Paths
    spark.sparkContext._jvm.java.nio.file.Files.createLink(to.get(target.toUri().getPath(), _strings(spark)), to.get(draft.toUri().getPath(), _strings(spark)))


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.String, 0)


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with a text in one step, which only one of several writers can do; False if the file is there.

    A store must be able to move a file to a name that is not taken, as one step: HDFS and local disks can.
    """
    fs, target = _file(spark, path)
    target = fs.makeQualified(target)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        (_claimed_by_link if fs.getScheme() == "file" else _claimed_by_rename)(spark, draft, target)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)
    return True


# Versioned tables


def _log(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and entry (name, note) of a table's current version; 0 if there is none."""
    numbers = [int(n) for n in names(spark, f"{path}/versions") if n.isdigit()]
    if not numbers:
        return 0, {}
    fs, p = _file(spark, f"{path}/versions/{max(numbers)}")
    source = fs.open(p)
    try:
        return max(numbers), json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def note(spark: SparkSession, path: str) -> dict:
    """What the writer of the current version noted with it."""
    return _log(spark, path)[1].get("note", {})


def _written(df: DataFrame, path: str) -> str:
    name = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    return name


def refresh(df: DataFrame, path: str, noted: dict | None = None) -> DataFrame:
    """Full replacement of the table at `path`, as one transaction; read it by :func:`current`.

    The rows go to a version of their own, which then becomes the current one by one small file. Until then, and if the job
    fails, readers have the version before; those that are reading it go on. If another writer comes first, this one replaces its
    version in turn. Old versions are the caller's to delete.
    """
    spark = df.sparkSession
    entry = json.dumps({"name": _written(df, path), "note": noted or {}})
    while not claim(spark, f"{path}/versions/{_log(spark, path)[0] + 1}", entry):
        pass
    return current(spark, path)


def update(spark: SparkSession, path: str, change: Callable[[DataFrame | None, dict], tuple[DataFrame, dict] | None], tries: int = 20) -> DataFrame:
    """A new version made from the current one: change(rows or None, note) gives rows and a note, or None for no change.

    If another writer comes first, what was written is dropped and change is asked again, with that writer's version.
    """
    for _ in range(tries):
        n, entry = _log(spark, path)
        made = change(spark.read.parquet(f"{path}/{entry['name']}") if n else None, entry.get("note", {}))
        if made is None:
            return current(spark, path)
        name = _written(made[0], path)
        if claim(spark, f"{path}/versions/{n + 1}", json.dumps({"name": name, "note": made[1]})):
            return spark.read.parquet(f"{path}/{name}")
        fs, lost = _file(spark, f"{path}/{name}")
        fs.delete(lost, True)
    raise RuntimeError(f"other writers came first {tries} times: {path}")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that :func:`refresh` or :func:`update` writes."""
    n, entry = _log(spark, path)
    if not n:
        raise FileNotFoundError(f"no version of a table at {path}")
    return spark.read.parquet(f"{path}/{entry['name']}")
