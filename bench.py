"""Times the headline queries and prints one line of JSON: seconds of the median of three warm runs.

Beside each query's seconds stand those of its SQL in DuckDB on the same files and as many threads, the rows that the query reads and
returns, and the MB that it shuffles.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

import duckdb
from pyspark.sql import SparkSession

from strataflow.plans import catalog
from strataflow.session import local_session

#: Headline jobs: features, score, coverage, merges, manifest and universe queries, and their incremental forms.
HEADLINE = ("G4_price_features", "G5_moat_score", "G6_coverage_refresh", "U1_silver_merge", "U2_upsert", "U6_surrogate_keys", "J3_fact_annual", "A1_coverage_base", "A10_latency", "J13_universe_dataset_coverage", "P27_screener_members", "G7_derived_metrics")
RUNS = 3


def timed(run, before=lambda: None) -> float:
    """Median seconds of RUNS runs after one that warms up."""
    times = []
    for _ in range(RUNS + 1):
        before()
        began = time.perf_counter()
        run()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times[1:]), 3)


def shuffled_mb(spark: SparkSession) -> float:
    """MB that the session's executors have written to shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size())) / 1e6


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect(config={"threads": cpus})
    duck.sql("SET timezone = 'UTC'")
    tables = [f.removesuffix(".parquet") for f in sorted(os.listdir(sf_dir)) if f.endswith(".parquet")]
    for t in tables:
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    counts = {t: duck.sql(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in tables}
    queries, oracles = catalog.queries(), catalog.oracle_sql()
    seconds, theirs, rows_in, rows_out, shuffled = {}, {}, {}, {}, {}
    for name in HEADLINE:
        before = shuffled_mb(spark)
        seconds[name] = timed(lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save(), spark.catalog.clearCache)  # noqa: B023
        shuffled[name] = round((shuffled_mb(spark) - before) / (RUNS + 1), 2)
        theirs[name] = timed(lambda: duck.sql(oracles[name]).fetchall())  # noqa: B023
        rows_in[name] = sum(n for t, n in counts.items() if re.search(rf"\b{t}\b", oracles[name]))
        rows_out[name] = duck.sql(f"SELECT count(*) FROM ({oracles[name]})").fetchall()[0][0]
    line = {"metric": "headline queries, median of three warm runs", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
    print(json.dumps(line | {"duckdb": theirs, "duckdb_value": round(sum(theirs.values()), 3), "rows_in": rows_in, "rows_out": rows_out, "shuffle_mb": shuffled}))
    spark.stop()


if __name__ == "__main__":
    main()
