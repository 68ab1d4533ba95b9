"""Every registered query of the engine against its DuckDB SQL on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from strataflow.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    want = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    rows = sorted(([plain(x) for x in r] for r in want.select(*[f'"{c}"' for c in columns]).fetchall()), key=repr)
    spark.catalog.clearCache()
    assert len(got) == len(rows)
    for g, r in zip(got, rows, strict=True):
        assert all(a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-5 * max(1, abs(b)) for a, b in zip(g, r, strict=True)), (g, r)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0
