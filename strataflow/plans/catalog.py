"""Registry of the engine's own queries and their SQL oracles."""

from __future__ import annotations

from . import composite, gold, ops, silver, universe  # noqa: F401  they register themselves
from .registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
