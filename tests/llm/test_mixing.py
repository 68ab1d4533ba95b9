import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import mixing as M


def slow_targets(sizes):
    """{source: target}: share by weight; what is above three sizes is capped and shared again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def rows_of(n):
    rows = []
    for i in range(n):
        source = ("a", "b", "c", None, "é")[i % 5 if i % 2 else 0]
        rows.append((i, " ".join(["w"] * (i * 7 % 53)), None, source))
    return [*rows, (n, None, None, "a"), (n + 1, "", None, "z"), (n + 2, "one two", None, "small"), (None, "x y z", None, "b"), (7, "dup dup", None, "b"), (7, "dup dup", None, "b")]


def test_targets_marginals_and_limits(documents):
    rows = rows_of(700)
    got = M.mix(documents(rows)).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += words(t)
    want = slow_targets(dict(sizes))
    assert sorted([(r.doc_id, r.size) for r in got], key=repr) == sorted([(i, words(t)) for i, t, _, _ in rows], key=repr)
    taken, largest, source = defaultdict(int), defaultdict(int), {(i, words(t)): s for i, t, _, s in rows}
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert r.size == 0 or int(rate + 1e-9) <= r.copies <= int(rate - 1e-9) + 1
        taken[s] += r.taken
        largest[s] = max(largest[s], 2 * r.size)
    assert all(abs(taken[s] - want[s]) <= max(largest[s], 1e-6) for s in sizes)


def test_reruns_agree_and_empty(documents):
    frame = documents(rows_of(300))
    a, b = (sorted([tuple(r) for r in M.mix(frame.repartition(n)).collect()], key=repr) for n in (2, 5))
    assert a == b
    assert M.mix(documents([])).count() == 0


def test_rounding_is_unbiased(spark):
    """Over many sources with the same documents, a document is taken as often as its fraction says."""
    parts = [(i, 3 + i % 5, 0.1 + 0.05 * i) for i in range(16)]
    n = 300
    units = spark.createDataFrame([(f"s{k}", *p) for k in range(n) for p in parts], "source string, id long, size long, part double")
    hits, words = defaultdict(int), defaultdict(int)
    for r in M.round_fractions(units, block=4).collect():
        hits[r.id] += r["take"]
        words[r.source] += r["take"] * r.size
    assert all(abs(hits[i] / n - p) < 0.13 for i, _, p in parts)
    want = sum(z * p for _, z, p in parts)
    assert all(abs(words[f"s{k}"] - want) < 7 for k in range(n))


def test_copies_of_rows_keep_columns(documents):
    frame = documents(rows_of(60)).withColumn("size", F.lit("mine")).withColumn("copies", F.lit(1))
    out = M.mix_documents(frame)
    want = M.mix(frame).agg(F.sum("taken")).first()[0]
    assert out.columns == frame.columns and out.agg(F.sum(M.n_words("text"))).first()[0] == want


def test_same_id_in_two_sources_and_any_column_names(spark):
    """Rows that share an id, null or not, are taken by their own source's rate."""
    rows = [(i % 3 or None, f"w{i} x y z", s) for s, n in (("a", 40), ("b", 400), ("c", 40)) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"unit": F.lit(1), "of": F.lit(2), "copies": F.lit(3), "copy": F.lit(4), "__size": F.lit(5), "a.b": F.lit(6)})
    out = M.mix_documents(frame)
    assert out.columns == frame.columns
    want = slow_targets({"a": 160, "b": 1600, "c": 160})
    took = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(M.n_words("text")).alias("n")).collect()}
    assert all(abs(took[s] - want[s]) <= 8 for s in want)


@pytest.mark.parametrize("ids", [(None,), (5,), (5, 6)])
def test_equal_rows_round_apart(documents, ids):
    """A hundred equal rows of a source meet its target within one document, in rows and in documents."""
    rows = [(ids[i % len(ids)], "one two three four", None, "a") for i in range(100)] + [(1000 + i, "w " * 9, None, "b") for i in range(50)]
    frame = documents(rows).repartition(7)
    want = slow_targets({"a": 400, "b": 450})
    got = M.mix(frame).collect()
    assert len(got) == 150 and all(0 <= r.taken <= 3 * r.size for r in got)
    equal = [r for r in got if r.size == 4]
    assert abs(sum(r.taken for r in equal) - want["a"]) <= 4 * len(ids) and max(r.copies for r in equal) - min(r.copies for r in equal) <= 1
    out = M.mix_documents(frame.withColumn("part", F.lit(1)))
    assert out.columns == [*frame.columns, "part"] and out.where("source = 'a'").count() == sum(r.copies for r in equal)
