"""Composite jobs: landing, promotion, recovery, reports and a whole run."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import coverage as C
from ..operators import fetch_plan as P
from ..operators import ops as O
from ..operators import report as R
from ..operators.upsert import allocate_sk, upsert
from ..sources import bronze as B
from ..sources.contracts import contract_from
from ..sources.storage import current, new_path, refresh, update
from ..streaming.promote import promote_batch, promote_stream
from . import gold, inputs as I
from . import ops as M
from . import silver as S
from .registry import query, rounded

BARS = contract_from({
    "domain": "eod", "source": "vendor", "dataset": "bars", "silver_table": "bars", "key_cols": ["symbol", "date"], "row_date_col": "date",
    "columns": [{"name": "symbol", "type": "str"}, {"name": "date", "type": "date"}, {"name": "close", "type": "float"}],
})


def landed(spark, sf_dir) -> str:
    """All payload documents, written to a fresh landing folder."""
    path = new_path(spark, "landing")
    B.write_bronze(S.envelopes(spark, sf_dir).drop("k", "bronze_filename", "_corrupt_record"), path)
    return path


SILVER = f"""{S.ENV}, ok AS (SELECT *, row_number() OVER () AS x FROM env WHERE {S.PROMOTE} AND {S.REJECT} IS NULL),
typed AS (SELECT k, 0 AS pos, 'T' || CAST(user_id % 60 AS VARCHAR) AS symbol, TRY_CAST(day AS DATE) AS date, CAST(k % 97 AS DOUBLE) AS close FROM ok WHERE n = 2 UNION ALL SELECT k, 1, 'X', TRY_CAST(day2 AS DATE), NULL FROM ok WHERE n = 2),
stamped AS (SELECT typed.*, CAST(k AS VARCHAR) AS file, date_trunc('second', ts) AS came FROM typed JOIN events ON event_id = k WHERE date IS NOT NULL),
silver AS (SELECT symbol, date, close, file AS bronze_file_id FROM stamped QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY came DESC, file DESC, pos DESC) = 1)"""


@query("S5_landed_documents", f"WITH {S.ENV} SELECT CASE WHEN has_request THEN CAST(k AS VARCHAR) END AS file_id, status AS status_code, CASE WHEN n IS NULL THEN -1 ELSE n END AS n FROM env")
def landed_documents(spark, sf_dir):
    docs = B.read_bronze(spark, landed(spark, sf_dir), lines=True)
    return docs.select(F.col("request.file_id").alias("file_id"), "status_code", F.coalesce(F.size("content"), F.lit(-1)).alias("n"))


@query("S9_recovered_manifest", f"WITH {S.ENV} SELECT CAST(k AS VARCHAR) AS file_id, event_type AS dataset, CAST(n AS BIGINT) AS bronze_rows, {S.PROMOTE} AND {S.REJECT} IS NULL AS bronze_can_promote FROM env WHERE has_request")
def recovered(spark, sf_dir):
    empty = I.manifest(spark, sf_dir).where("1 = 0")
    rebuilt, _ = B.recover_manifest(spark, empty, landed(spark, sf_dir), lines=True, today=F.lit(S.TODAY))
    return rebuilt.select("file_id", "dataset", "bronze_rows", "bronze_can_promote")


@query("T1_stream_promotion", f"WITH {SILVER} SELECT * FROM silver")
def stream(spark, sf_dir):
    """Landed files promoted by a streaming run, twice: the second one finds nothing new."""
    landing, target, checkpoint = landed(spark, sf_dir), new_path(spark, "silver"), new_path(spark, "stream")
    for _ in range(2):
        promote_stream(spark, landing, BARS, target, checkpoint, lines=True).awaitTermination()
    return spark.read.parquet(target).select("symbol", "date", "close", "bronze_file_id")


@query("G1_promote_silver", f"WITH {SILVER} SELECT symbol, date, close, bronze_file_id, CAST(year(date) AS INTEGER) AS row_year, CAST(month(date) AS INTEGER) AS row_month FROM silver")
def promote(spark, sf_dir):
    """One batch promoted into month folders (T3), and replayed (T4)."""
    target = new_path(spark, "silver")
    docs = B.read_bronze(spark, landed(spark, sf_dir), lines=True)
    for _ in range(2):
        promote_batch(spark, docs, BARS, target, partition="month")
    return spark.read.parquet(target).select("symbol", "date", "close", "bronze_file_id", "row_year", "row_month")


_KEYLESS = f"{SILVER}, lost AS (SELECT CAST(k AS VARCHAR) AS bronze_file_id, 'T' || CAST(ok.user_id % 60 AS VARCHAR) AS symbol, CAST(k % 97 AS DOUBLE) AS close, TRY_CAST(day AS DATE) AS date, date_trunc('second', ts) AS came, 0 AS pos FROM ok JOIN events ON event_id = k WHERE n = 2 UNION ALL SELECT CAST(k AS VARCHAR), 'X', NULL, TRY_CAST(day2 AS DATE), date_trunc('second', ts), 1 FROM ok JOIN events ON event_id = k WHERE n = 2)"


@query("T4_replay", f"WITH {_KEYLESS} SELECT 'silver' AS into_table, symbol, date, close, bronze_file_id FROM silver UNION ALL SELECT 'errors', symbol, date, close, bronze_file_id FROM lost WHERE date IS NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY came DESC, bronze_file_id DESC, pos DESC) = 1")
def replay(spark, sf_dir):
    """A batch done three times: Silver and its table of errors are those of doing it once."""
    target = new_path(spark, "silver")
    docs = B.read_bronze(spark, landed(spark, sf_dir), lines=True)
    for _ in range(3):
        promote_batch(spark, docs, BARS, target)
    pick = lambda name, path: spark.read.parquet(path).select(F.lit(name).alias("into_table"), "symbol", "date", "close", "bronze_file_id")
    return pick("silver", target).unionByName(pick("errors", f"{target}_errors"))


@query("T3_year_batches", f"WITH {SILVER} SELECT CAST(year(date) AS INTEGER) AS row_year, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM silver GROUP BY 1")
def year_batches(spark, sf_dir):
    """Files dealt to two batches by their date, each promoted into year folders."""
    target = new_path(spark, "silver")
    docs = B.read_bronze(spark, landed(spark, sf_dir), lines=True)
    early = F.col("now").try_cast("timestamp") < F.lit("2024-01-16").cast("timestamp")
    for part in (docs.where(~early | early.isNull()), docs.where(early)):  # the later ones first: their rows stay
        promote_batch(spark, part, BARS, target, partition="year")
    return spark.read.parquet(target).groupBy(F.col("row_year").cast("int").alias("row_year")).agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("T5_chunked_promotion", f"WITH {SILVER} SELECT symbol, count(*) AS n, count(DISTINCT date) AS days FROM silver GROUP BY 1")
def chunked(spark, sf_dir):
    """A stream over the landing folder, one file of documents at a time."""
    landing, target, checkpoint = landed(spark, sf_dir), new_path(spark, "silver"), new_path(spark, "stream")
    promote_stream(spark, landing, BARS, target, checkpoint, max_files=1, lines=True).awaitTermination()
    return spark.read.parquet(target).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("date").alias("days"))


def _priced(rows: DataFrame) -> DataFrame:
    return rows.where(F.element_at("row", F.lit("close")).isNotNull()).withColumn("row", F.map_concat(F.map_filter("row", lambda k, _: k != "symbol"), F.create_map(F.lit("symbol"), F.concat(F.lit("#"), F.element_at("row", F.lit("symbol"))))))


@query("X1_reshape_promotion", f"WITH {SILVER.replace('WHERE date IS NOT NULL)', 'WHERE date IS NOT NULL AND close IS NOT NULL)')} SELECT '#' || symbol AS symbol, date, close FROM silver")
def reshaped(spark, sf_dir):
    """A contract whose hook leaves out rows without a price and renames symbols before they are typed."""
    target = new_path(spark, "silver")
    promote_batch(spark, B.read_bronze(spark, landed(spark, sf_dir), lines=True), replace(BARS, reshape=_priced), target)
    return spark.read.parquet(target).select("symbol", "date", "close")


@query("U8_full_refresh", f"WITH {M.INDEX} SELECT dataset, ticker, discriminator, total_files FROM idx")
def full_refresh(spark, sf_dir):
    """The coverage index in the place of an older one."""
    path = new_path(spark, "coverage")
    index = M.index(spark, sf_dir).select("dataset", "ticker", "discriminator", "total_files")
    refresh(index.where("ticker < 'T010'"), path)
    refresh(index, path)
    return current(spark, path)


@query("U8_two_writers", f"WITH {M.BASE} SELECT dataset, CAST(sum(total_files) AS BIGINT) AS n_files FROM base GROUP BY 1")
def two_writers(spark, sf_dir):
    """Two writers add to one table at once: the one that comes second is asked again, and nothing is lost."""
    path = new_path(spark, "coverage")
    counts = C.coverage_base(I.manifest(spark, sf_dir)).groupBy("dataset").agg(F.sum("total_files").alias("n_files"))
    early, late = counts.where("dataset < 'purchase'"), counts.where("dataset >= 'purchase'")
    tries = []

    def slow(old, noted):
        tries.append(1)
        if len(tries) == 1:  # the other writer comes between
            update(spark, path, lambda o, n: (late if o is None else o.unionByName(late), n))
        return (early if old is None else old.unionByName(early)), noted

    update(spark, path, slow)
    if len(tries) != 2:
        raise AssertionError("the second writer was not asked again")
    return current(spark, path)


@query("U6_two_writers", "WITH old AS (SELECT s_name AS symbol, CAST(s_suppkey AS BIGINT) AS sk FROM supplier), one AS (SELECT * FROM old UNION ALL SELECT symbol, (SELECT max(sk) FROM old) + row_number() OVER (ORDER BY symbol) FROM (SELECT DISTINCT c_name AS symbol FROM customer)), parts AS (SELECT DISTINCT p_name AS symbol FROM part UNION SELECT c_name FROM customer) SELECT * FROM one UNION ALL SELECT symbol, (SELECT max(sk) FROM one) + row_number() OVER (ORDER BY symbol) FROM parts WHERE symbol NOT IN (SELECT symbol FROM one)")
def two_key_writers(spark, sf_dir):
    """Two writers number new symbols at once: no number is given twice, and a symbol that both bring gets one."""
    path = new_path(spark, "keys")
    symbols = lambda table, column: I.table(spark, sf_dir, table).select(F.col(column).alias("symbol"))
    refresh(I.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"), F.col("s_suppkey").cast("bigint").alias("sk")), path)
    first, second = symbols("customer", "c_name"), symbols("part", "p_name").union(symbols("customer", "c_name"))
    between = [lambda: update(spark, path, lambda old, noted: (allocate_sk(old, first, ["symbol"], "sk"), noted))]

    def slow(old, noted):
        keys = allocate_sk(old, second, ["symbol"], "sk")
        if between:
            between.pop()()
        return keys, noted

    return update(spark, path, slow)


_EARLY = "came < TIMESTAMP '2024-01-16'"
_LAST = "QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY came DESC, file DESC, pos DESC) = 1"


@query(
    "T2_mark_store",
    f"""WITH {SILVER}, a AS (SELECT * FROM stamped WHERE {_EARLY} {_LAST}), m AS (SELECT symbol, max(date) AS mark FROM a GROUP BY 1),
    b AS (SELECT s.* FROM (SELECT * FROM stamped WHERE NOT ({_EARLY}) {_LAST}) s LEFT JOIN m USING (symbol) WHERE mark IS NULL OR date > mark),
    every AS (SELECT symbol, date, close, file FROM a UNION ALL SELECT symbol, date, close, file FROM b)
    SELECT symbol, date, close, file AS bronze_file_id, max(date) OVER (PARTITION BY symbol) AS watermark FROM every""",
)
def mark_store(spark, sf_dir):
    """Two batches under marks per symbol, the second one twice: its rows that are not after their symbol's mark are late."""
    target = new_path(spark, "silver")
    docs = B.read_bronze(spark, landed(spark, sf_dir), lines=True)
    early = F.col("now").try_cast("timestamp") < F.lit("2024-01-16").cast("timestamp")
    for part in (docs.where(early), docs.where(~early | early.isNull()), docs.where(~early | early.isNull())):
        promote_batch(spark, part, BARS, target, watermark="date", partition="year", mark_keys=("symbol",))
    return spark.read.parquet(target).select("symbol", "date", "close", "bronze_file_id").join(current(spark, f"{target}_marks"), "symbol")


@query("S10_create_table", f"WITH {I.PRICES} SELECT symbol, count(*) AS n FROM prices GROUP BY 1")
def create_table(spark, sf_dir):
    path = new_path(spark, "prices")
    I.prices(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def _long(section: str, item: str, source: str, *metrics: str) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, coalesce({item}, '') AS item, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {source}" for m in metrics)


@query(
    "G9_run_report",
    f"""WITH {M.PRESENCE},
    dom AS (SELECT domain, count(*) AS files, count(bronze_error) AS failed, count(DISTINCT dataset) AS datasets, count(DISTINCT ticker) AS tickers, coalesce(sum(bronze_rows), 0) AS rows FROM manifest WHERE run_id = 'R03' GROUP BY ROLLUP (domain)),
    ds AS (SELECT domain, dataset, count(*) AS files, count(*) - count(bronze_error) AS passed, count(bronze_error) AS failed, coalesce(sum(bronze_rows), 0) AS rows FROM manifest WHERE run_id = 'R03' GROUP BY 1, 2),
    pr AS (SELECT dataset, count(silver_injest_start_time) AS promoted, coalesce(sum(silver_rows_created), 0) AS created, coalesce(sum(silver_rows_failed), 0) AS failed, count(silver_errors) AS errors FROM manifest WHERE run_id = 'R03' AND bronze_can_promote GROUP BY 1),
    un AS (SELECT count(*) AS universe, count(*) FILTER (WHERE in_bronze) AS in_bronze, count(*) FILTER (WHERE in_silver) AS in_silver, count(*) FILTER (WHERE in_bronze AND NOT in_silver) AS bronze_only, count(*) FILTER (WHERE NOT in_bronze) AS not_ingested, round(count(*) FILTER (WHERE in_bronze) * 100.0::DOUBLE / count(*), 2) AS bronze_pct FROM presence),
    kinds AS (SELECT DISTINCT dataset FROM manifest), hit AS (SELECT DISTINCT dataset, ticker FROM manifest WHERE bronze_error IS NULL),
    ud AS (SELECT k.dataset, count(*) AS universe, count(hit.ticker) AS have, count(*) - count(hit.ticker) AS lack FROM kinds k CROSS JOIN universe u LEFT JOIN hit ON hit.dataset = k.dataset AND hit.ticker = u.ticker GROUP BY 1)
    {_long("domain", "domain", "dom", "files", "failed", "datasets", "tickers", "rows")} UNION ALL {_long("dataset", "dataset", "ds", "files", "passed", "failed", "rows")}
    UNION ALL {_long("promotion", "dataset", "pr", "promoted", "created", "failed", "errors")} UNION ALL {_long("universe", "''", "un", "universe", "in_bronze", "in_silver", "bronze_only", "not_ingested", "bronze_pct")}
    UNION ALL {_long("universe_dataset", "dataset", "ud", "universe", "have", "lack")}""",
)
def run_report(spark, sf_dir):
    return R.run_report(I.manifest(spark, sf_dir), M.universe(spark, sf_dir), "R03")


_COLS = ("moat_score_s", "stability_s", "wacc_f")
_PROF = " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) AS n, min({c}) AS least, avg({c}) AS mean, max({c}) AS most, count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*) AS null_pct FROM scored" for c in _COLS)


@query(
    "G10_validation_report",
    f"""WITH {gold.SCORED}, yr AS (SELECT CAST(calendar_year AS VARCHAR) AS y, count(*) AS n_rows FROM scored GROUP BY 1), pf AS ({_PROF}),
    fb AS (SELECT CAST(calendar_year AS VARCHAR) AS y, count(*) AS n, count(*) FILTER (WHERE benchmark_level = 'sector') AS n_sector, count(*) FILTER (WHERE benchmark_level = 'sector') * 100.0::DOUBLE / count(*) AS sector_pct FROM scored GROUP BY 1),
    every AS ({_long("year", "y", "yr", "n_rows")} UNION ALL {_long("profile", "c", "pf", "n", "least", "mean", "most", "null_pct")} UNION ALL {_long("fallback", "y", "fb", "n", "n_sector", "sector_pct")})
    SELECT section, item, metric, round(value, 6) AS value FROM every""",
)
def validation(spark, sf_dir):
    return rounded(R.validation_report(gold.moat(spark, sf_dir), list(_COLS)))


@query(
    "G11_full_run",
    f"""WITH {gold.FEATURES}, {I.ANNUAL}, {M.INDEX}, marks AS ({M.BULK}),
    due AS (SELECT * FROM marks WHERE (last_ingested_at IS NULL OR date_diff('day', CAST(last_ingested_at AS DATE), DATE '{M.TODAY}') > 40) AND coalesce(last_to_date + 1, DATE '1990-01-01') <= DATE '{M.TODAY}')
    SELECT 'due' AS layer, count(*) AS n FROM due UNION ALL SELECT 'fact_eod', count(*) FROM fact_eod UNION ALL SELECT 'features', count(momentum_1m_f) FROM feats
    UNION ALL SELECT 'moat', count(*) FROM annual JOIN customer ON c_custkey = instrument_sk WHERE revenue > 0 UNION ALL SELECT 'coverage', count(*) FROM idx UNION ALL SELECT 'manifest', count(*) FROM manifest""",
)
def full_run(spark, sf_dir):
    """Due set, facts, features, scores and coverage of one run, as the rows that each layer holds after it."""
    manifest = I.manifest(spark, sf_dir)
    marks = O.bulk_watermarks(manifest)
    due = P.due(marks.select(*C.IDENTITY, F.lit(40).alias("min_age_days")), marks, M.TODAY)
    facts = gold.fact_eod(spark, sf_dir)
    facts = upsert(facts.where("date_sk % 2 = 0"), facts, ["instrument_sk", "date_sk"])
    features = gold.price_features(spark, sf_dir).where("momentum_1m_f IS NOT NULL")
    layers: dict[str, DataFrame] = {"due": due, "fact_eod": facts, "features": features, "moat": gold.moat(spark, sf_dir), "coverage": M.index(spark, sf_dir), "manifest": manifest}
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n") for name, df in layers.items()])
