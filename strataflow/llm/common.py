"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import new_path, stored  # noqa: F401  the operators take them from here

#: The white space of all word and normalisation rules, [\x20\x09-\x0D].
BLANKS = b" \t\n\x0b\x0c\r"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_if_null(name: str) -> Column:
    return F.coalesce(named(name), F.lit(""))


def unused(*names: str, taken: list[str]) -> list[str]:
    """names made longer until they clash with none of `taken`, in whatever case."""
    held, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
