"""Incremental forms against full ones: coverage, features, promotion; versioned tables with several writers."""

import datetime as dt
import json
import random
import shutil
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from strataflow.operators import coverage as C
from strataflow.operators import coverage_state as S
from strataflow.operators import features as W
from strataflow.operators.key_filter import add_keys, maybe_there
from strataflow.plans import inputs as I
from strataflow.sources import storage as K


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Versioned tables


def test_one_of_two_claims(spark):
    path = K.new_path(spark, "claims") + "/log"
    assert K.claim(spark, f"{path}/1", "first") and not K.claim(spark, f"{path}/1", "second")
    assert K.names(spark, path) == ["1"] and K.exists(spark, f"{path}/1") and not K.exists(spark, f"{path}/2")


def test_claim_by_rename_takes_no_name_that_is_there(spark):
    from py4j.protocol import Py4JJavaError

    folder = K.new_path(spark, "claims")
    made = []
    for name in ("a", "b"):
        fs, p = K._file(spark, f"{folder}/{name}")
        fs.create(p, False).close()
        made.append(fs.makeQualified(p))
    target = K._file(spark, f"{folder}/t")[1]
    K._claimed_by_rename(spark, made[0], K._file(spark, folder)[0].makeQualified(target))
    with pytest.raises(Py4JJavaError, match="FileAlreadyExists"):
        K._claimed_by_rename(spark, made[1], K._file(spark, folder)[0].makeQualified(target))


def test_second_writer_starts_from_the_first_ones_version(spark):
    path = K.new_path(spark, "numbers")
    seen = []

    def add(n, between=None):
        def change(old, noted):
            seen.append((n, noted.get("n", 0)))
            if between and len(seen) == 1:
                between()
            rows = spark.createDataFrame([(n,)], "n long")
            return (rows if old is None else old.unionByName(rows)), {"n": noted.get("n", 0) + n}

        return K.update(spark, path, change)

    add(1, lambda: add(10))
    assert collected(K.current(spark, path)) == [(1,), (10,)] and K.note(spark, path) == {"n": 11}
    assert seen == [(1, 0), (10, 0), (1, 10)]
    before = K.names(spark, path)
    assert collected(K.update(spark, path, lambda old, noted: None)) == [(1,), (10,)] and K.names(spark, path) == before
    assert len([n for n in before if n.startswith("v-")]) == 2  # what the second writer wrote first is gone


def test_refresh_after_another_writer(spark, monkeypatch):
    path = K.new_path(spark, "numbers")
    rows = lambda n: spark.createDataFrame([(n,)], "n long")
    K.refresh(rows(1), path)
    real, raced = K.claim, []

    def claim(session, where, text):
        if not raced:
            raced.append(1)
            real(session, where, json.dumps({"name": K._written(rows(2), path), "note": {}}))
        return real(session, where, text)

    monkeypatch.setattr(K, "claim", claim)
    assert collected(K.refresh(rows(3), path)) == [(3,)]
    assert K.names(spark, f"{path}/versions") == ["1", "2", "3"]


# Coverage


def test_fold_reads_new_batches_only(spark, sf):
    manifest = I.manifest(spark, sf).withColumn("k", F.xxhash64("file_id") % 3)
    path, state = K.new_path(spark, "manifest"), K.new_path(spark, "state")
    for i, k in enumerate((-2, -1, 0)):
        manifest.where(F.col("k").isin(k, k + 3)).drop("k").write.parquet(f"{path}/batch={i}")
        S.fold(spark, path, state)
        assert S.covered(spark, state) == [f"batch={j}" for j in range(i + 1)]
        # What has been folded is never read again: its files are spoilt.
        for f in K.names(spark, f"{path}/batch={i}"):
            open(urlparse(f"{path}/batch={i}/{f}").path, "wb").close()
    want = collected(C.coverage_base(manifest).select(*S.base_of(K.current(spark, state)).columns))
    assert collected(S.base_of(K.current(spark, state))) == want
    assert collected(S.base_of(S.fold(spark, path, state))) == want  # nothing new: nothing read
    shutil.rmtree(urlparse(f"{path}/batch=0").path)
    assert collected(S.base_of(S.fold(spark, path, state))) == want


def test_corrections_count_once(spark, sf):
    after = I.manifest(spark, sf)
    before = after.withColumns({"silver_rows_created": F.lit(None).cast("bigint"), "silver_rows_failed": F.lit(0).cast("bigint"), "bronze_can_promote": F.lit(True)})
    path, state = K.new_path(spark, "manifest"), K.new_path(spark, "state")
    before.write.parquet(f"{path}/batch=a")
    S.fold(spark, path, state)
    for _ in range(2):
        S.correct(spark, state, "promotion", before, after)
    got = S.base_of(K.current(spark, state))
    assert collected(got) == collected(C.coverage_base(after).select(*got.columns))


# Features


@pytest.mark.parametrize("seed", [1, 2])
def test_late_corrected_and_deleted_prices(spark, seed):
    """Renewed features are those of a full build; symbols of one row, new and vanished ones, prices of zero among them."""
    rng = random.Random(seed)
    day = dt.date(2010, 1, 1)
    old = {(s, day + dt.timedelta(i)): (0.0 if rng.random() < 0.01 else 10 + rng.random()) for s in "abc" for i in range(700) if rng.random() < 0.9}
    old |= {("gone", day): 1.0, ("short", day): 2.0}
    new = dict(old)
    for s, at in (("a", 5), ("a", 300), ("b", 695)):
        for i in range(at, at + rng.randrange(1, 6)):
            new[s, day + dt.timedelta(i)] = 99.0 + i  # late or corrected
    for i in (310, 311, 400):
        new.pop(("b", day + dt.timedelta(i)), None)  # deleted
    new[("a", day + dt.timedelta(302))] = 0.0  # no price any more
    del new["gone", day]
    new |= {("fresh", day + dt.timedelta(i)): 5.0 + i for i in range(40)} | {("short", day - dt.timedelta(1)): 3.0}
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], "symbol string, date date, adj_close double")
    before, after = frame(old), frame(new)
    features = W.price_features(before, ["symbol"], "date")
    changed = W.changed_rows(before, after, ["symbol", "date"], "adj_close")
    got = W.renewed_price_features(after, features, changed, ["symbol"], "date")
    want = W.price_features(after, ["symbol"], "date")
    plain = lambda df: {(r.symbol, r.date): tuple(None if x is None else pytest.approx(x, rel=1e-9, abs=1e-12) for x in r[2:]) for r in df.collect()}
    a, b = plain(got), plain(want)
    assert a.keys() == b.keys() and all(tuple(r[2:]) == b[r.symbol, r.date] for r in got.collect())
    # What isn't reached by a change is taken over as it was, not computed again.
    marked = features.withColumn("volatility_30d_f", F.lit(-1.0))
    kept = W.renewed_price_features(after, marked, changed, ["symbol"], "date").where("volatility_30d_f = -1")
    assert kept.where("symbol = 'c'").count() == want.where("symbol = 'c'").count() and kept.where("symbol = 'b' AND date < DATE '2010-11-07'").count() > 200
    assert kept.where("symbol IN ('fresh', 'short', 'gone')").count() == 0


# Promotion


def test_filter_has_every_key_and_few_others(spark):
    path = K.new_path(spark, "filter")
    rows = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3 + 2000).cast("int").alias("y"))
    folder = F.col("y")
    for part in (rows.where("k % 2 = 0"), rows.where("k % 2 = 1"), rows.where("k < 100")):
        add_keys(part, path, ["k"], folder)
    assert collected(maybe_there(rows, path, ["k"], folder)) == collected(rows)
    others = rows.withColumn("k", F.col("k") + 10_000)
    assert maybe_there(others, path, ["k"], folder).count() == 0
    assert maybe_there(rows.withColumn("y", F.lit(1990)), path, ["k"], folder).count() == 0
    assert maybe_there(rows.where("k < 0"), path, ["k"], folder).count() == 0
    small = K.new_path(spark, "filter")
    add_keys(rows, small, ["k"], folder, bits=1 << 12)
    assert maybe_there(others, small, ["k"], folder, bits=1 << 12).count() > 50  # crowded: false hits, no false misses
    assert maybe_there(rows, small, ["k"], folder, bits=1 << 12).count() == 3000


def batches(spark, sf):
    from strataflow.plans import composite as P
    from strataflow.sources import bronze as B

    docs = B.read_bronze(spark, P.landed(spark, sf), lines=True)
    early = F.col("now").try_cast("timestamp") < F.lit("2024-01-16").cast("timestamp")
    return P.BARS, docs.where(early), docs.where(~early | early.isNull())


def silver(spark, target):
    return collected(spark.read.parquet(target).select("symbol", "date", "close", "bronze_file_id"))


def test_promotion_with_a_crowded_filter_and_without_the_files_beside(spark, sf, monkeypatch):
    """False hits change nothing, and a target that is older than its filter and marks gets them."""
    from strataflow.operators import key_filter as X
    from strataflow.streaming.promote import promote_batch

    contract, first, second = batches(spark, sf)
    results = []
    for crowded in (False, True):
        if crowded:
            monkeypatch.setattr(X.add_keys, "__defaults__", (1 << 8,))
            monkeypatch.setattr(X.maybe_there, "__defaults__", (1 << 8,))
        target = K.new_path(spark, "silver")
        promote_batch(spark, first, contract, target, partition="year")
        if not crowded:
            shutil.rmtree(urlparse(f"{target}_keys").path)
        promote_batch(spark, second, contract, target, partition="year")
        promote_batch(spark, second, contract, target, partition="year", watermark="date")
        results.append(silver(spark, target))
        assert K.current(spark, f"{target}_marks").first()[0] == max(r[1] for r in results[-1])
    assert results[0] == results[1]


def test_new_keys_read_no_old_folder(spark, sf):
    """With its old data files spoilt, a batch of keys that the filter lacks is promoted as before."""
    from strataflow.streaming.promote import promote_batch

    contract, first, second = batches(spark, sf)
    target = K.new_path(spark, "silver")
    promote_batch(spark, first, contract, target, watermark="date", partition="year", mark_keys=("symbol",))
    names = [f"{target}/{d}/{f}" for d in K.names(spark, target) if d.startswith("row_year=") for f in K.names(spark, f"{target}/{d}") if f.endswith(".parquet")]
    held = {n: open(urlparse(n).path, "rb").read() for n in names}
    for n in names:
        open(urlparse(n).path, "wb").close()
    promote_batch(spark, second, contract, target, watermark="date", partition="year", mark_keys=("symbol",))
    for n, data in held.items():
        with open(urlparse(n).path, "wb") as f:
            f.write(data)
    marks = {r[0]: r[1] for r in K.current(spark, f"{target}_marks").collect()}
    rows = silver(spark, target)
    assert all(marks[s] == max(r[1] for r in rows if r[0] == s) for s in {r[0] for r in rows})


def test_a_failed_batch_is_done_again(spark, sf, monkeypatch):
    """Rows are written but marks aren't: the same batch afterwards adds nothing twice, and the marks move on."""
    from strataflow.streaming import promote as Q

    contract, first, second = batches(spark, sf)
    plain, failing = K.new_path(spark, "silver"), K.new_path(spark, "silver")
    options = {"watermark": "date", "mark_keys": ("symbol",)}
    for part in (first, second):
        Q.promote_batch(spark, part, contract, plain, **options)
    Q.promote_batch(spark, first, contract, failing, **options)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(Q, "update", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        Q.promote_batch(spark, second, contract, failing, **options)
    Q.promote_batch(spark, second, contract, failing, **options)
    assert silver(spark, failing) == silver(spark, plain)
    assert collected(K.current(spark, f"{failing}_marks")) == collected(K.current(spark, f"{plain}_marks"))


# Distinct counts


def test_bitmaps_count_any_range_exactly(spark):
    """Batches in any order and twice, more tickers than a block holds, numbers that never change."""
    from strataflow.operators import distinct_counts as D

    rng = random.Random(4)
    day = dt.date(2024, 1, 25)
    rows = [(rng.choice("ab"), rng.choice([None, "", *(f"T{i}" for i in range(400))]), day + dt.timedelta(rng.randrange(20))) for _ in range(3000)]
    path, numbers = K.new_path(spark, "bitmaps"), K.new_path(spark, "numbers")
    frame = spark.createDataFrame(rows, "dataset string, ticker string, d date")
    assert D.distinct_tickers(spark, path).count() == 0
    first = None
    for part in (frame.where("dataset = 'b'"), frame, frame.where("d > DATE '2024-02-01'")):
        known = D.number_tickers(spark, numbers, part)
        first = first or {r[0]: r[1] for r in known.collect()}
        D.add_rows(part, known.withColumn("ticker_no", F.col("ticker_no") * 1000), path, F.col("d"))  # spread over blocks
    last = {r[0]: r[1] for r in K.current(spark, numbers).collect()}
    assert last.items() >= first.items() and sorted(last.values()) == list(range(1, len(last) + 1))
    for a, b in ((None, None), (day, day), (day + dt.timedelta(3), day + dt.timedelta(11)), (None, day + dt.timedelta(8))):
        want = {k: len({t for x, t, d in rows if x == k and t and (a is None or d >= a) and (b is None or d <= b)}) for k in "ab"}
        assert {r.dataset: r.n_tickers for r in D.distinct_tickers(spark, path, a, b).collect()} == want
