"""Exact quantiles and percent ranks: the way of large groups gives what the way of small ones gives."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import peers as P

PS = [0.01, 0.25, 0.99, 1.0]


def drawn(seed=1):
    """Rows (key, year, a, b, c): a third of them in one group, ties, outliers, nulls, constants, one-row groups."""
    rng = random.Random(seed)
    rows = []
    for _ in range(900):
        key = "hot" if rng.random() < 0.4 else rng.choice(["x", "y", None, "z" + str(rng.randrange(30))])
        a = rng.choice([rng.gauss(0, 1), 10.0 ** rng.randrange(-300, 300), -(10.0 ** rng.randrange(-300, 300)), 0.5, 0.5, 0.5])
        b = None if rng.random() < 0.3 else float(rng.randrange(4))
        rows.append((key, rng.choice([2000, 2001]), a, b, 7.25 if rng.random() < 0.9 else None))
    rows += [("nulls", 2000, None, None, None)] * 3 + [("odd", 2000, float("inf"), float("nan"), 1.0), ("odd", 2000, 1.0, 2.0, 3.0)]
    rows += [("tied", 2000, 1.7e308 if i % 2 else -1.7e308, 1.0 + i // 50 * 2.0**-52, float(i)) for i in range(200)]
    return rows


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(drawn(), "k string, y int, a double, b double, c double").repartition(5)


def quantile(values, p):
    values = sorted(v for v in values if v is not None and math.isfinite(v))
    if not values:
        return None
    at = p * (len(values) - 1)
    low, high = math.floor(at), math.ceil(at)
    return values[low] if low == high else (high - at) * values[low] + (at - low) * values[high]


@pytest.mark.parametrize(("fits", "buckets"), [(P.FITS, P.BUCKETS), (40, 64)])
def test_quantiles(frame, fits, buckets, monkeypatch):
    monkeypatch.setattr(P, "BUCKETS", buckets)
    groups = {}
    for k, y, *v in drawn():
        if k is not None:
            groups.setdefault((k, y), []).append(v)
    got = {(r.k, r.y): r.quantiles for r in P.group_quantiles(frame, ["k", "y"], ["a", "b", "c"], PS, fits=fits).collect()}
    assert got.keys() == groups.keys()
    for key, rows in groups.items():
        for i in range(3):
            want = [quantile([r[i] for r in rows], p) for p in PS]
            assert all(g == w or (w is not None and math.isclose(g, w, rel_tol=1e-12)) for g, w in zip(got[key][i], want, strict=True)), (key, i, got[key][i], want)


@pytest.mark.parametrize("fits", [P.FITS, 30])
def test_percent_ranks_with_ties_over_ranges(frame, fits):
    """A null key is a key; 200 rows of 5 values are dealt to ranges."""
    rows = drawn()
    place = lambda v: (v is None, 0 if v is None else (math.isnan(v), v))
    groups = {}
    for k, y, a, b, c in rows:
        groups.setdefault((k, y), []).append((a, b, c))
    numbered = frame.where("k IS NULL OR k <> 'odd'").withColumn("id", F.monotonically_increasing_id())
    got = P.percent_ranks(numbered, ["k", "y"], {"ra": "a", "rb": "b"}, fits=fits)
    assert got.columns == [*numbered.columns, "ra", "rb"]
    found = got.collect()
    assert len(found) == len({r.id for r in found}) == len(rows) - 2
    for r in found:
        group = groups[r.k, r.y]
        for mine, value, i in ((r.ra, r.a, 0), (r.rb, r.b, 1)):
            below = sum(place(g[i]) < place(value) for g in group)
            assert mine == pytest.approx(below / (len(group) - 1) if len(group) > 1 else 0.0)


def test_no_percentile_buffers_in_the_score(spark, sf):
    from strataflow.plans import gold

    plan = gold.moat(spark, sf)._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan
    assert np.isfinite([r.moat_score_s for r in gold.moat(spark, sf).select("moat_score_s").limit(5).collect()]).all()


def test_empty(spark):
    none = spark.createDataFrame([], "k string, a double")
    assert P.group_quantiles(none, ["k"], ["a"], PS).count() == 0
    assert P.percent_ranks(none, ["k"], {"r": "a"}).count() == 0
