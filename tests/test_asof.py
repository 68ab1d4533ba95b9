"""As-of join against a plain search, with a hot key over many ranges, ties, nulls and keys of one side only."""

import datetime as dt
import random

import pytest

from strataflow.operators.asof import as_of_join

DAY = dt.date(2020, 1, 1)


def on(n):
    return None if n is None else DAY + dt.timedelta(n)


def drawn(seed):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "left only", "right only", None])
    left = [(key(), rng.choice([None, *range(60)]), i) for i in range(300)] + [("hot", 30, 300), ("hot", 30, 300)]
    left = [r for r in left if r[0] != "right only"]
    right = [(key(), rng.choice([None, *range(20, 60, 3)]), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice(["x", "y"])) for _ in range(120)]
    return left, [r for r in right if r[0] != "left only"]


def slow(left, right, within=None):
    out = []
    for k, t, i in left:
        fit = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        best = max(fit, key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3]), default=None)
        if best is not None and within is not None and t - best[1] > within:
            best = None
        out.append((k, on(t), i, *(best[2:] if best else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "within"), [(1, None), (2, 4)])
def test_equals_a_plain_search(spark, seed, within):
    left, right = drawn(seed)
    a = spark.createDataFrame([(k, on(t), i) for k, t, i in left], "k string, t date, i int")
    b = spark.createDataFrame([(k, on(t), v, w) for k, t, v, w in right], "k string, t date, v double, w string")
    got = as_of_join(a, b, ["k"], "t", ["v", "w"], within)
    assert got.columns == ["k", "t", "i", "v", "w"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == slow(left, right, within)


def test_empty_sides_and_no_other_columns(spark):
    a = spark.createDataFrame([("a", on(1))], "k string, t date")
    b = spark.createDataFrame([("a", on(0), 5)], "k string, t date, v int")
    assert [tuple(r) for r in as_of_join(a, b, ["k"], "t", ["v"]).collect()] == [("a", on(1), 5)]
    assert [tuple(r) for r in as_of_join(a, b.where("1 = 0"), ["k"], "t", ["v"]).collect()] == [("a", on(1), None)]
    assert as_of_join(a.where("1 = 0"), b, ["k"], "t", ["v"]).count() == 0
