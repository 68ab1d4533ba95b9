"""Contract type hints as safe column expressions, and the naming rules between vendor and table columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The words that a boolean hint takes as true.
TRUE_WORDS = ("true", "t", "1", "yes", "y")

#: Spark type of each hint.
HINT_TYPES = {"str": "string", "int": "bigint", "int64": "bigint", "bigint": "bigint", "float": "double", "bool": "boolean", "date": "date", "datetime": "timestamp", "list": "array<string>", "dict": "map<string,string>"}


def snake(name: str) -> str:
    """camelCase to snake_case: a capital starts a word where lower case follows it, or comes before it."""
    spaced = re.sub(r"(?<=.)(?=[A-Z][a-z]+)", "_", name)
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", spaced).lower()


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def base_hint(hint: str) -> str:
    """The first part of a hint such as ``int | None``."""
    return hint.split("|")[0].strip()


def to_number(c: Column) -> Column:
    """A double, or null where the value is no number."""
    return c.cast("string").try_cast("double")


def to_bool(c: Column) -> Column:
    text = F.lower(F.trim(c.cast("string")))
    number = text.try_cast("double")
    return F.coalesce(text.isin(*TRUE_WORDS) | (F.abs(number) >= 1), F.lit(False))


def coerce(c: Column, hint: str) -> Column:
    """`c` as a contract's hint wants it: numbers, dates and times that don't parse are null, text is never null."""
    kind = base_hint(hint)
    if kind == "str":
        return F.coalesce(c.cast("string"), F.lit(""))
    if kind in ("int", "int64", "bigint"):
        return F.bround(to_number(c)).try_cast("bigint")
    if kind == "float":
        return F.nanvl(to_number(c), F.lit(None).cast("double"))
    if kind == "bool":
        return to_bool(c)
    if kind == "date":
        return c.cast("string").try_cast("date")
    if kind == "datetime":
        return c.cast("string").try_cast("timestamp")
    if kind == "list":
        return F.coalesce(c.cast("array<string>"), F.array().cast("array<string>"))
    if kind == "dict":
        return F.coalesce(c.cast("map<string,string>"), F.create_map().cast("map<string,string>"))
    raise ValueError(f"no such type hint: {hint}")


def iso_seconds(c: Column) -> Column:
    """ISO-8601 text in UTC, to the second."""
    return F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def header_map(c: Column) -> Column:
    """``k=v; k=v`` as a map."""
    return F.str_to_map(c, F.lit("; "), F.lit("="))


def forex_pair(symbol: Column) -> tuple[Column, Column]:
    """Base and quote currency of a six-letter pair, else nulls."""
    six = F.length(symbol) == 6
    return F.when(six, F.left(symbol, F.lit(3))), F.when(six, F.right(symbol, F.lit(3)))
