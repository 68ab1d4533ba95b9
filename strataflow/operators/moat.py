"""The six-pillar company score: raw ratios, cost of capital, rolling features, peer normalisation, pillars."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored
from .features import growth, ratio_of_changes, series, slope, trailing
from .peers import group_quantiles, group_sizes, known_keys, percent_ranks

#: Country names of the risk-premium source and their ISO codes.
COUNTRY_CODES = {
    "United States": "US", "Canada": "CA", "United Kingdom": "GB", "Germany": "DE", "France": "FR", "Japan": "JP", "China": "CN",
    "Hong Kong": "HK", "Singapore": "SG", "India": "IN", "South Korea": "KR", "Taiwan": "TW", "Brazil": "BR", "Mexico": "MX",
    "Italy": "IT", "Spain": "ES", "Netherlands": "NL", "Sweden": "SE", "Switzerland": "CH", "Norway": "NO", "Denmark": "DK", "Finland": "FI",
    "Belgium": "BE", "Austria": "AT", "Australia": "AU", "New Zealand": "NZ", "Israel": "IL", "South Africa": "ZA", "Russia": "RU", "Poland": "PL",
    "Czech Republic": "CZ", "Hungary": "HU", "Greece": "GR", "Turkey": "TR", "Indonesia": "ID", "Malaysia": "MY", "Thailand": "TH", "Philippines": "PH",
    "Argentina": "AR", "Chile": "CL", "Colombia": "CO", "Peru": "PE", "United Arab Emirates": "AE", "Saudi Arabia": "SA", "Egypt": "EG",
    "Nigeria": "NG", "Ireland": "IE", "Portugal": "PT", "Luxembourg": "LU", "Iceland": "IS", "Cyprus": "CY", "Malta": "MT", "Pakistan": "PK",
    "Bangladesh": "BD", "Vietnam": "VN", "Ukraine": "UA", "Romania": "RO", "Bulgaria": "BG", "Serbia": "RS", "Croatia": "HR", "Slovenia": "SI",
    "Slovakia": "SK", "Estonia": "EE", "Latvia": "LV", "Lithuania": "LT", "Kazakhstan": "KZ", "Kenya": "KE", "Ghana": "GH", "Morocco": "MA",
    "Algeria": "DZ", "Tunisia": "TN", "Sri Lanka": "LK", "Myanmar": "MM", "Cambodia": "KH",
}


@dataclass(frozen=True)
class Feature:
    """A scored feature: `name`_raw becomes `name`_f; lower_is_better turns the scale round."""

    name: str
    lower_is_better: bool = False

    @property
    def raw(self) -> str:
        return f"{self.name}_raw"


#: The features that are scaled against peers, and whether less of them is better.
FEATURES = (
    Feature("roic"),
    Feature("roic_spread"),
    Feature("roic_spread_5y_mean"),
    Feature("roic_spread_trend"),
    Feature("gross_margin"),
    Feature("operating_margin"),
    Feature("fcf_margin"),
    Feature("margin_volatility", True),
    Feature("recession_resilience"),
    Feature("revenue_growth"),
    Feature("deferred_rev_pct"),
    Feature("sm_pct", True),
    Feature("cogs_ratio", True),
    Feature("sga_ratio", True),
    Feature("asset_turnover"),
    Feature("rev_per_employee"),
    Feature("rd_pct"),
    Feature("intangibles_pct"),
    Feature("incremental_roic"),
)
#: Each pillar's features and weight.
PILLARS = {
    "profitability": (0.30, ("roic", "roic_spread", "roic_spread_5y_mean", "roic_spread_trend")),
    "stability": (0.25, ("gross_margin", "operating_margin", "fcf_margin", "margin_volatility", "recession_resilience")),
    "competitive": (0.15, ("revenue_growth", "gross_margin_vs_industry", "operating_margin_vs_industry")),
    "lock_in": (0.10, ("deferred_rev_pct", "sm_pct")),
    "cost_advantage": (0.15, ("cogs_ratio", "sga_ratio", "asset_turnover", "rev_per_employee")),
    "reinvestment": (0.05, ("rd_pct", "intangibles_pct", "incremental_roic")),
}
NEUTRAL = 0.5
#: (level, keys beside the year, fewest peers), the first with enough peers counts.
LEVELS = (("industry", "industry_sk", 10), ("sector", "sector_sk", 5))
DEFAULTS = {"rf": 0.04, "erp": 0.055, "beta": 1.0}


def risk_free(yields: DataFrame, date: str = "date", rate: str = "rate") -> DataFrame:
    """(calendar_year, rf): a year's mean yield in percent, values outside 0 to 20 left out."""
    return yields.groupBy(F.year(date).alias("calendar_year")).agg((F.avg(F.when(F.col(rate).between(0, 20), F.col(rate))) / 100).alias("rf"))


def recession_years(flags: DataFrame, date: str = "date", flag: str = "recession_flag") -> DataFrame:
    return flags.where(F.col(flag) == 1).select(F.year(date).alias("calendar_year")).distinct()


def country_code(name: Column) -> Column:
    """ISO code of a country name; null if unknown."""
    pairs = [F.lit(x) for pair in COUNTRY_CODES.items() for x in pair]
    return F.element_at(F.create_map(*pairs), name)


def with_market_inputs(facts: DataFrame, betas: DataFrame, premiums: DataFrame, rates: DataFrame, home: str = "US") -> DataFrame:
    """facts (symbol, country_code, calendar_year) with beta, erp and rf; missing ones take the home country's, then the default.

    premiums (country_code, erp) and rates (calendar_year, rf) hold a row for each country or year; betas (symbol,
    beta) are joined by whatever plan suits their size.
    """
    at_home = premiums.where(F.col("country_code") == home).agg(F.max("erp").alias("__home"))  # one row
    joined = facts.join(betas, "symbol", "left").join(premiums, "country_code", "left").join(rates, "calendar_year", "left").crossJoin(F.broadcast(at_home))
    return joined.withColumns({
        "beta": F.coalesce("beta", F.lit(DEFAULTS["beta"])), "erp": F.coalesce("erp", "__home", F.lit(DEFAULTS["erp"])), "rf": F.coalesce("rf", F.lit(DEFAULTS["rf"])),
    }).drop("__home")


def cost_of_capital(debt: Column, equity: Column, interest: Column, before_tax: Column, tax: Column, rf: Column, beta: Column, erp: Column) -> Column:
    """Weighted cost of capital: equity at 4 % at least, debt between 2 and 30 %, tax up to half, the whole between 4 and 25 %."""
    within = lambda low, c, high: F.greatest(F.lit(low), F.least(F.lit(high), c))
    capital = debt + equity
    of_equity = F.greatest(F.lit(0.04), rf + F.greatest(F.lit(0.0), beta) * erp)
    of_debt = within(0.02, F.when((debt > 0) & (interest > 0), interest / debt).otherwise(F.lit(0.05)), 0.30)
    tax_rate = within(0.0, F.when(before_tax > 0, tax / before_tax).otherwise(F.lit(0.21)), 0.5)
    share = lambda part: part / F.nullif(capital, F.lit(0.0))
    mixed = share(equity) * of_equity + share(debt) * of_debt * (1.0 - tax_rate)
    return within(0.04, F.when(capital <= 0, F.lit(0.08)).otherwise(mixed), 0.25)


def raw_ratios(base: DataFrame) -> DataFrame:
    """base with wacc_raw and the ratios that need one row only. Rows need revenue above zero."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    c = F.col
    rows = base.where(c("revenue") > 0)
    per = lambda part, whole: part / F.nullif(whole, F.lit(0.0))
    sga, rd = zero("selling_general_and_administrative_expenses"), zero("research_and_development_expenses")
    return rows.withColumns({
        "wacc_raw": cost_of_capital(zero("total_debt"), zero("total_stockholders_equity"), zero("interest_expense"), c("income_before_tax"), zero("income_tax_expense"), c("rf"), c("beta"), c("erp")),
        "roic_raw": zero("roic"),
        "gross_margin_raw": per(c("gross_profit"), c("revenue")),
        "operating_margin_raw": per(c("operating_income"), c("revenue")),
        "fcf_margin_raw": per(zero("free_cash_flow"), c("revenue")),
        "deferred_rev_pct_raw": per(zero("deferred_revenue"), c("revenue")),
        "sm_pct_raw": per(F.greatest(F.lit(0.0), sga - rd), c("revenue")),
        "cogs_ratio_raw": per(F.greatest(F.lit(0.0), c("revenue") - c("gross_profit")), c("revenue")),
        "sga_ratio_raw": per(sga, c("revenue")),
        "asset_turnover_raw": per(c("revenue"), zero("total_assets")),
        "rev_per_employee_raw": F.when(zero("full_time_employees") > 0, c("revenue") / c("full_time_employees")),
        "rd_pct_raw": per(rd, c("revenue")),
        "intangibles_pct_raw": per(zero("goodwill_and_intangible_assets"), zero("total_assets")),
    })


def rolled(raw: DataFrame, recessions: DataFrame, entity: str = "instrument_sk", year: str = "calendar_year") -> DataFrame:
    """raw with the features that look back over an entity's rows; one sort serves them all."""
    over, five, ten = series([entity], year), trailing([entity], year, 5), trailing([entity], year, 10)
    out = raw.withColumn("roic_spread_raw", F.col("roic_raw") - F.col("wacc_raw")).withColumns({
        "roic_spread_5y_mean_raw": F.avg(F.col("roic_raw") - F.col("wacc_raw")).over(five),
        "roic_spread_trend_raw": slope(F.col("roic_raw") - F.col("wacc_raw"), over, 4),
        "margin_volatility_raw": F.stddev_samp("operating_margin_raw").over(five),
        "revenue_growth_raw": growth(F.col("revenue"), over, 1),
        "incremental_roic_raw": ratio_of_changes(F.col("roic_raw") * F.col("invested_capital"), F.col("invested_capital"), over, 3),
    })
    marked = out.join(recessions.select(F.col("calendar_year").alias(year), F.lit(True).alias("__recession")), year, "left")
    return marked.withColumn("recession_resilience_raw", F.avg(F.when(F.col("__recession"), F.col("revenue_growth_raw"))).over(ten)).drop("__recession")


STATISTICS = ("p01", "p99", "mean", "std")


def peer_table(rows: DataFrame, keys: list[str], features: list[str], sizes: DataFrame | None = None) -> DataFrame:
    """Per group of non-null keys: peer_n, and `peers`, an array with the STATISTICS of each feature; stored.

    sizes: the groups' sizes, if the caller has them.
    """
    n = F.count(F.lit(1)).alias("peer_n")
    if not features:
        return stored(known_keys(rows, keys).groupBy(*keys).agg(n, F.array().alias("peers")), "peers")
    moments = F.array(*[F.struct(F.avg(f).alias("mean"), F.stddev_samp(f).alias("std")) for f in features]).alias("__moments")
    found = group_quantiles(rows, keys, features, [0.01, 0.99], sizes, beside=[n, moments])
    one = F.zip_with("quantiles", "__moments", lambda q, m: F.struct(F.get(q, F.lit(0)).alias("p01"), F.get(q, F.lit(1)).alias("p99"), m["mean"].alias("mean"), m["std"].alias("std")))
    return stored(found.select(*keys, "peer_n", one.alias("peers")), "peers")


def peer_stats(rows: DataFrame, keys: list[str], features: list[str], prefix: str = "") -> DataFrame:
    """Per group of non-null keys: peer_n, and p01, p99, mean and std of each feature."""
    out = [F.get(F.col("peers"), i)[s].alias(f"{prefix}{f}_{s}") for i, f in enumerate(features) for s in STATISTICS]
    return peer_table(rows, keys, features).select(*keys, F.col("peer_n").alias(f"{prefix}peer_n"), *out)


def scaled(raw: Column, p01: Column, p99: Column, mean: Column, std: Column, lower_is_better: bool | Column = False, neutral_on_degenerate: bool = False, reflect_mean: bool = False) -> Column:
    """Winsorised z-score, three deviations either side mapped to 0 and 1.

    Without deviation there is no z-score: the smallest and largest of what is left is then 1, or the neutral
    value if asked for. Where lower is better, the default turns round the held value but not the mean, as the source system
    does, so that peers with a positive mean and a small deviation all come to 0; `reflect_mean` turns round the z-score as a whole.
    """
    low = lower_is_better if isinstance(lower_is_better, Column) else F.lit(lower_is_better)
    held = F.greatest(F.coalesce(p01, raw), F.least(F.coalesce(p99, raw), raw))
    mean, sign = F.coalesce(mean, raw), F.when(low, -1.0).otherwise(1.0)
    z = (sign * (held - mean) if reflect_mean else sign * held - mean) / F.nullif(std, F.lit(0.0))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (z + 3.0) / 6.0))
    return F.when(z.isNull(), F.lit(NEUTRAL)).otherwise(score) if neutral_on_degenerate else score


def by_level(rows: DataFrame, levels: tuple[tuple[str, str, int], ...], year: str, columns: list[str]) -> DataFrame:
    """(level, key, year, columns): each row once for each level."""
    each = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.col(key).cast("bigint").alias("key")) for level, key, _ in levels]))
    return rows.select(each.alias("of"), year, *columns).select("of.*", year, *columns)


def normalised(rows: DataFrame, features: tuple[Feature, ...] = FEATURES, levels: tuple[tuple[str, str, int], ...] = LEVELS, year: str = "calendar_year", neutral_on_degenerate: bool = False, reflect_mean: bool = False, statistics_from: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """rows with `name`_f for each feature, against the first level with enough peers, else neutral; null stays null.

    statistics_from: the same rows where reading them takes less than computing `rows` anew, and the sizes of their groups by level.

    A group's statistics travel as one array, and one expression over the features serves them all: a column for each
    statistic and level would make a generated method too large for the JVM to compile. Both levels are counted in one pass.
    """
    raws = [f.raw for f in features]
    source, sizes = (rows, None) if statistics_from is None else statistics_from
    peers = peer_table(by_level(source, levels, year, raws), ["level", "key", year], raws, sizes)
    out = rows
    for level, key, _ in levels:
        stats = peers.where(F.col("level") == level).select(F.col("key").cast(rows.schema[key].dataType).alias(key), year, F.col("peer_n").alias(f"__{level}_n"), F.col("peers").alias(f"__{level}"))
        out = out.join(stats, [key, year], "left")
    first, _, fewest = levels[0]
    n = F.coalesce(F.col(f"__{first}_n"), F.lit(0)).cast("int")
    enough = F.coalesce(*[F.when(F.col(f"__{level}_n") >= least, F.col(f"__{level}")) for level, _, least in levels])
    out = out.withColumns({"__peers": enough, "industry_peer_n": n, "benchmark_level": F.when(n >= fewest, first).otherwise(levels[-1][0])})
    own = F.array(*[F.struct(F.col(f.raw).alias("raw"), F.lit(f.lower_is_better).alias("low")) for f in features])

    def score(x: Column, i: Column) -> Column:
        s = F.get(F.col("__peers"), i)
        value = scaled(x["raw"], s["p01"], s["p99"], s["mean"], s["std"], x["low"], neutral_on_degenerate, reflect_mean)
        return F.when(x["raw"].isNull(), F.lit(None).cast("double")).when(F.col("__peers").isNull(), F.lit(NEUTRAL)).otherwise(value)

    out = out.withColumn("__scores", F.transform(own, score))
    return out.withColumns({f"{f.name}_f": F.get("__scores", i) for i, f in enumerate(features)}).drop(*[c for c in out.columns if c.startswith("__")])


def null_safe_mean(*parts: Column) -> Column:
    """Mean in which a missing part counts as neutral."""
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(NEUTRAL)) for p in parts]) / F.lit(float(len(parts)))


def pillar_scores(rows: DataFrame) -> DataFrame:
    """rows with `pillar`_s and the weighted moat_score_s."""
    out = rows.withColumns({f"{p}_s": null_safe_mean(*[F.col(f"{f}_f") for f in fs]) for p, (_, fs) in PILLARS.items()})
    return out.withColumn("moat_score_s", reduce(lambda a, b: a + b, [F.lit(w) * F.col(f"{p}_s") for p, (w, _) in PILLARS.items()]))


def steady(rows: DataFrame, digits: int) -> DataFrame:
    """rows with raw features rounded: among peers that agree, noise in the last place would be scaled up to a score."""
    return rows.withColumns({f.raw: F.round(f.raw, digits) for f in FEATURES})


def moat_scores(base: DataFrame, recessions: DataFrame, digits: int = 9) -> DataFrame:
    """All steps over base rows that carry market inputs, industry_sk and sector_sk.

    The rolled features feed the statistics, the ranks and the final join, so they are stored once they are made.
    """
    features = stored(steady(rolled(raw_ratios(base), recessions), digits), "features")
    level, key, _ = LEVELS[0]
    sizes = group_sizes(by_level(features, LEVELS, "calendar_year", []), ["level", "key", "calendar_year"])
    own = sizes.where(F.col("level") == level).select(F.col("key").cast(features.schema[key].dataType).alias(key), "calendar_year", "n")
    ranked = percent_ranks(features, [key, "calendar_year"], {f"{m}_vs_industry_f": f"{m}_raw" for m in ("gross_margin", "operating_margin")}, own)
    return pillar_scores(normalised(ranked, statistics_from=(features, sizes))).withColumn("wacc_f", F.col("wacc_raw"))


# Diagnostics


def profile(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, least, mean, most, null_pct) of each column, from one pass."""
    parts = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n"), F.min(c).alias("least"), F.avg(c).alias("mean"), F.max(c).alias("most"), (F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1))).alias("null_pct")) for c in columns]
    return rows.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def fallback_rate(rows: DataFrame, year: str = "calendar_year") -> DataFrame:
    """Per year: rows, rows scored against the sector, and their share in percent."""
    sector = F.count_if(F.col("benchmark_level") == "sector")
    return rows.groupBy(year).agg(F.count(F.lit(1)).alias("n"), sector.alias("n_sector"), (sector * 100.0 / F.count(F.lit(1))).alias("sector_pct"))


def implausible_wacc(rows: DataFrame, low: float, high: float, n: int) -> DataFrame:
    """The n rows outside the limits that are furthest from 8 %."""
    return rows.where((F.col("wacc_f") < low) | (F.col("wacc_f") > high)).orderBy(F.desc(F.abs(F.col("wacc_f") - 0.08)), "instrument_sk", "calendar_year").limit(n)


def quintiles(rows: DataFrame, score: str, tie: str, year: str = "calendar_year") -> DataFrame:
    """Latest year's rows by fifths of the score: (quintile, n, least, mean, most).

    The fifths are those of NTILE, found without one ordered partition: rows are counted in order inside ranges
    of the score, and ranges are offset by those before them.
    """
    latest = rows.join(F.broadcast(rows.agg(F.max(year).alias(year))), year)
    order = [F.asc_nulls_last(score), F.asc(tie)]
    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    parts = stored(latest.repartitionByRange(ranges, F.col(score).asc_nulls_last(), F.col(tie)).withColumn("__part", F.spark_partition_id()), "ranks")
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    total = sizes.agg(F.sum("__n").alias("__total"))
    place = parts.withColumn("__i", F.row_number().over(Window.partitionBy("__part").orderBy(*order))).join(F.broadcast(starts), "__part").crossJoin(F.broadcast(total))
    at, size, extra = F.col("__start") + F.col("__i") - 1, F.floor(F.col("__total") / 5), F.col("__total") % 5
    long = extra * (size + 1)
    fifth = F.when(at < long, F.floor(at / (size + 1))).otherwise(extra + F.floor((at - long) / F.greatest(size, F.lit(1)))) + 1
    return place.withColumn("quintile", fifth.cast("int")).groupBy("quintile").agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("least"), F.avg(score).alias("mean"), F.max(score).alias("most"))
