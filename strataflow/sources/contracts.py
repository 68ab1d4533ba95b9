"""Dataset contracts: identity, keys, row date, recipes and typed columns of a Silver table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import HINT_TYPES, base_hint

SCOPES = ("global", "per_ticker")


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: bool = True
    api: str | None = None


@dataclass(frozen=True)
class Recipe:
    plans: tuple[str, ...] = ()
    query_vars: tuple[str, ...] = ()
    min_age_days: int = 0
    date_key: str | None = None
    cadence: str = "interval"

    @property
    def uses_date_range(self) -> bool:
        return bool({"from", "to"} & set(self.query_vars))


@dataclass(frozen=True)
class Contract:
    domain: str
    source: str
    dataset: str
    silver_table: str
    key_cols: tuple[str, ...]
    columns: tuple[ContractColumn, ...]
    discriminator: str = ""
    ticker_scope: str = "global"
    row_date_col: str | None = None
    recipes: tuple[Recipe, ...] = field(default_factory=tuple)
    #: A change to the payload rows before they are typed; set by code (dataclasses.replace), not by configuration.
    reshape: Callable[[DataFrame], DataFrame] | None = None

    @property
    def identity(self) -> tuple[str, str, str, str]:
        return self.domain, self.source, self.dataset, self.discriminator

    def ddl(self) -> str:
        """The Silver table's schema, without lineage."""
        return ", ".join(f"`{c.name}` {HINT_TYPES[base_hint(c.type)]}" for c in self.columns)


def contract_from(entry: dict) -> Contract:
    """A validated contract from one parsed configuration entry."""
    needed = ("domain", "source", "dataset", "silver_table", "key_cols", "columns")
    missing = [k for k in needed if not entry.get(k)]
    if missing:
        raise ValueError(f"contract lacks {', '.join(missing)}: {entry.get('dataset')}")
    columns = tuple(ContractColumn(c["name"], c["type"], c.get("nullable", True), c.get("api")) for c in entry["columns"])
    for c in columns:
        if base_hint(c.type) not in HINT_TYPES:
            raise ValueError(f"{entry['dataset']}.{c.name}: no such type hint: {c.type}")
    scope = entry.get("ticker_scope", "global")
    if scope not in SCOPES:
        raise ValueError(f"{entry['dataset']}: no such ticker scope: {scope}")
    names = {c.name for c in columns} | {"discriminator"}
    if lost := [k for k in entry["key_cols"] if k not in names]:
        raise ValueError(f"{entry['dataset']}: keys that are no columns: {', '.join(lost)}")
    recipes = tuple(Recipe(tuple(r.get("plans", ())), tuple(r.get("query_vars", ())), r.get("min_age_days", 0), r.get("date_key"), r.get("cadence", "interval")) for r in entry.get("recipes", ()))
    return Contract(entry["domain"], entry["source"], entry["dataset"], entry["silver_table"], tuple(entry["key_cols"]), columns, entry.get("discriminator") or "", scope, entry.get("row_date_col"), recipes)


def load_contracts(entries: list[dict]) -> list[Contract]:
    """All contracts of a parsed file; an identity may occur once."""
    out = [contract_from(e) for e in entries]
    seen: set[tuple] = set()
    for c in out:
        if c.identity in seen:
            raise ValueError(f"contract twice: {c.identity}")
        seen.add(c.identity)
    return out


def load_yaml(path: str) -> list[Contract]:
    import yaml  # an optional dependency: entries may come from anywhere else

    with open(path, encoding="utf-8") as f:
        return load_contracts(yaml.safe_load(f)["datasets"])


def contract_table(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """One row per contract and recipe, for joins with a manifest."""
    rows = [
        (i, c.domain, c.source, c.dataset, c.discriminator, "", c.ticker_scope, list(r.plans), r.uses_date_range, r.min_age_days, c.row_date_col)
        for i, c in enumerate(contracts)
        for r in (c.recipes or (Recipe(),))
    ]
    return spark.createDataFrame(rows, "contract_id int, domain string, source string, dataset string, discriminator string, ticker string, ticker_scope string, plans array<string>, uses_date_range boolean, min_age_days int, row_date_col string")


def included_plans(recipes: DataFrame, plan: str, order: tuple[str, ...]) -> DataFrame:
    """Recipes of a plan or of one below it in the order; recipes without plans are in all."""
    allowed = F.array(*[F.lit(p) for p in order[: order.index(plan) + 1]])
    return recipes.where((F.size("plans") == 0) | F.arrays_overlap("plans", allowed))
