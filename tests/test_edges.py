"""Edge cases of single operators."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strataflow.functions.coerce import camel, coerce, forex_pair, snake
from strataflow.functions.dates import business_days, federal_holidays
from strataflow.operators import moat as M
from strataflow.operators import project as P
from strataflow.operators.features import price_features
from strataflow.operators.fetch_plan import backward_windows, due
from strataflow.operators.universe import UniverseDefinition
from strataflow.operators.upsert import allocate_sk, latest_per, split_null_keys, upsert
from strataflow.sources import bronze as B
from strataflow.sources import dims as D
from strataflow.sources.contracts import contract_from, load_contracts
from strataflow.streaming.promote import promote_batch, promote_stream

ENTRY = {
    "domain": "eod", "source": "v", "dataset": "bars", "silver_table": "bars", "key_cols": ["symbol", "date"], "row_date_col": "date",
    "columns": [{"name": "symbol", "type": "str"}, {"name": "date", "type": "date"}, {"name": "adj_close", "type": "float", "api": "adjClose"}],
}


def test_names():
    assert [snake(x) for x in ("adjClose", "exchangeShortName", "isEtf", "symbol")] == ["adj_close", "exchange_short_name", "is_etf", "symbol"]
    assert camel("exchange_short_name") == "exchangeShortName"


@pytest.mark.parametrize(
    ("hint", "value", "want"),
    [
        ("str", None, ""), ("str", " x ", " x "), ("int", "2.5", 2), ("int", "3.5", 4), ("int | None", "abc", None), ("float", ".", None), ("float", "1e3", 1000.0), ("bool", None, False), ("bool", "T", True),
        ("bool", "yes", True), ("bool", "y", True), ("bool", "2", True), ("bool", "0.9", False), ("bool", "false", False), ("date", "2024-02-30", None), ("date", "2024-02-29", dt.date(2024, 2, 29)), ("list", None, []),
    ],
)
def test_coercion(spark, hint, value, want):
    kind = "array<string>" if hint == "list" else "string"
    assert spark.range(1).select(coerce(F.lit(value).cast(kind), hint).alias("v")).first().v == want


def test_projection_prefers_the_vendor_name_and_fills_what_is_absent(spark):
    df = spark.createDataFrame([("a", "2024-01-02", "1.5", "9")], "symbol string, date string, adjClose string, adj_close string")
    assert P.project(df, contract_from(ENTRY)).first().adj_close == 1.5
    assert P.add_snake_columns(df).columns == df.columns
    assert P.project(df.drop("adjClose", "adj_close"), contract_from(ENTRY)).first().adj_close is None
    with pytest.raises(ValueError, match="date"):
        P.require_keys(df.drop("date"), ["symbol", "date"])


def test_contracts_are_validated():
    with pytest.raises(ValueError, match="twice"):
        load_contracts([ENTRY, ENTRY])
    with pytest.raises(ValueError, match="hint"):
        contract_from(ENTRY | {"columns": [{"name": "symbol", "type": "money"}]})
    with pytest.raises(ValueError, match="keys"):
        contract_from(ENTRY | {"key_cols": ["nope"]})


def test_watermark_is_strict_and_may_be_off(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, d)) for d in (1, 2, 3)] + [("b", dt.date(2020, 1, 1))], "k string, d date")
    marks = spark.createDataFrame([("a", dt.date(2024, 1, 2))], "k string, watermark date")
    days = lambda x: sorted((r.k, r.d.day) for r in x.collect())
    assert days(P.watermark_filter(df, marks, ["k"], "d")) == [("a", 3), ("b", 1)]
    assert days(P.watermark_filter(df, marks, ["k"], "d", mode="global")) == [("a", 3)]
    assert P.watermark_filter(df, marks, ["k"], "d", mode="none").count() == P.watermark_filter(df, marks, ["k"], None).count() == 4


def test_upsert_is_idempotent_and_keeps_the_last(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1)], "k int, v string, n int")
    once = upsert(old, new, ["k"], order=[F.desc("n")])
    assert sorted(map(tuple, once.collect()), key=repr) == [(1, "a"), (2, "d"), (3, None)]
    assert sorted(map(tuple, upsert(once, new, ["k"], order=[F.desc("n")]).collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    good, lost = split_null_keys(spark.createDataFrame([(None, 1), (1, 2)], "k int, v int"), ["k"])
    assert good.count() == lost.count() == 1
    assert latest_per(new, ["k"], [F.desc("n")]).count() == 2


def test_surrogate_keys_are_stable_dense_and_ordered(spark):
    none = spark.createDataFrame([], "s string, sk long")
    first = allocate_sk(none, spark.createDataFrame([(f"x{i:03}",) for i in range(100)], "s string"), ["s"], "sk")
    rows = {r.s: r.sk for r in first.collect()}
    assert rows == {f"x{i:03}": i + 1 for i in range(100)}
    more = {r.s: r.sk for r in allocate_sk(spark.createDataFrame(list(rows.items()), "s string, sk long"), spark.createDataFrame([("a",), ("x005",)], "s string"), ["s"], "sk").collect()}
    assert more == rows | {"a": 101}


def test_features_skip_bad_prices_and_start_null(spark):
    rows = [("a", d, float(p)) for d, p in enumerate([10, 0, 11, 12.1], 1)] + [("b", 1, 5.0)]
    out = {(r.s, r.d): r for r in price_features(spark.createDataFrame(rows, "s string, d int, p double"), ["s"], "d", "p").collect()}
    assert ("a", 2) not in out and out["a", 1].volatility_30d_f is None and out["b", 1].momentum_1m_f is None
    assert out["a", 4].volatility_30d_f == pytest.approx(0, abs=1e-9)


def test_scores_without_deviation(spark):
    one = spark.range(1).select(*[M.scaled(F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(0.0), False, n).alias(f"x{n}") for n in (False, True)], M.null_safe_mean(F.lit(None).cast("double"), F.lit(1.0)).alias("m"), M.country_code(F.lit("Japan")).alias("c"), M.country_code(F.lit("Mars")).alias("z")).first()
    assert one.xFalse == 1.0 and one.xTrue == 0.5 and one.m == 0.75 and one.c == "JP" and one.z is None


def test_universe_hash_ignores_order_and_follows_conditions():
    a, b = UniverseDefinition("u", exchanges=("X", "Y")), UniverseDefinition("u", exchanges=("Y", "X"))
    assert a.filter_hash() == b.filter_hash() != UniverseDefinition("u", exchanges=("X",)).filter_hash()
    assert UniverseDefinition("u").parameters() == {}


def test_fetch_windows(spark):
    ident = "domain string, source string, dataset string, discriminator string, ticker string"
    key = ("eod", "v", "d", "", "")
    today = dt.date(2024, 1, 10)
    contracts = spark.createDataFrame([(*key, 3, True)], f"{ident}, min_age_days int, uses_date_range boolean")
    marks = lambda day: spark.createDataFrame([(*key, dt.datetime(2024, 1, day), dt.date(2024, 1, day))], f"{ident}, last_ingested_at timestamp, last_to_date date")
    assert [r.from_date for r in due(contracts, marks(6), today).collect()] == [dt.date(2024, 1, 7)]
    assert due(contracts, marks(7), today).count() == due(contracts, marks(10), today).count() == 0
    point = spark.createDataFrame([(*key, dt.date(1990, 1, 3))], f"{ident}, earliest_bronze_from date")
    floors = spark.createDataFrame([], f"{ident}, floor_date date")
    assert [tuple(r)[-2:] for r in backward_windows(contracts, point, floors, 30).collect()] == [(dt.date(1990, 1, 1), dt.date(1990, 1, 2))]
    at_start = spark.createDataFrame([(*key, dt.date(1990, 1, 1))], f"{ident}, floor_date date")
    assert backward_windows(contracts, point, at_start, 30).count() == 0


def test_calendar_and_business_days(spark):
    days = D.calendar(spark)
    assert days.count() == 14975 and days.where("date_sk = 20240101").first().day_name == "Monday"
    assert dt.date(2021, 7, 5) in federal_holidays(2021) and dt.date(2024, 11, 28) in federal_holidays(2024)
    after = {r.date: r.next_business_day for r in business_days(spark, 2023, 2024).where("date IN (DATE'2023-12-29', DATE'2024-07-03')").collect()}
    assert after == {dt.date(2023, 12, 29): dt.date(2024, 1, 2), dt.date(2024, 7, 3): dt.date(2024, 7, 5)}
    types = D.vocabulary(spark, D.INSTRUMENT_TYPES, "sk", "name")
    assert D.seed(types, types, ["name"]).count() == len(D.INSTRUMENT_TYPES)


def test_forex_pairs(spark):
    a, b = forex_pair(F.lit("EURUSD"))
    c, _ = forex_pair(F.lit("EUR"))
    assert tuple(spark.range(1).select(a, b, c).first()) == ("EUR", "USD", None)


def document(file_id, now, content, **other):
    request = {"domain": "eod", "source": "v", "dataset": "bars", "run_id": "r", "file_id": file_id}
    return {"request": request, "now": now, "elapsed_microseconds": 5, "headers": "a=b", "status_code": 200, "reason": "OK", "content": content, "error": None} | other


def test_stream_promotes_landed_files_once_and_isolates_bad_ones(spark, tmp_path):
    landing, target, checkpoint = (f"{tmp_path}/{x}" for x in ("landing", "silver", "checkpoint"))
    (tmp_path / "landing" / "sub").mkdir(parents=True)
    put = lambda name, doc: (tmp_path / "landing" / name).write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=1))
    bar = lambda s, d, c: {"symbol": s, "date": d, "adjClose": c}
    put("a.json", document("f1", "2024-01-01 00:00:00", [bar("A", "2024-01-01", 1.0), bar("A", "2024-01-01", 2.0), bar("B", "bad", 3)]))
    put("broken.json", "{not json")
    put("sub/failed.json", document("f2", "2024-01-01 00:00:00", [bar("Z", "2024-01-01", 1)], status_code=500))
    contract = contract_from(ENTRY)
    run = lambda: promote_stream(spark, landing, contract, target, checkpoint, max_files=2).awaitTermination()
    run()
    put("b.json", document("f3", "2024-01-02 00:00:00", [bar("A", "2024-01-01", 9.0), bar("A", "2024-01-02", 4.0)]))
    run()
    run()
    rows = sorted((r.symbol, r.date.day, r.adj_close) for r in spark.read.parquet(target).collect())
    assert rows == [("A", 1, 2.0), ("A", 2, 4.0)]
    assert spark.read.parquet(f"{target}_errors").count() == 1
    files = B.read_bronze(spark, landing)
    assert [r.bronze_filename.endswith("broken.json") for r in files.collect() if r._corrupt_record] == [True]
    rebuilt, unreadable = B.recover_manifest(spark, B.bronze_manifest(files).where("1 = 0"), landing)
    assert rebuilt.count() == 3 and unreadable.first().unreadable == 1
    assert {r.file_id: r.bronze_can_promote for r in rebuilt.collect()} == {"f1": True, "f2": False, "f3": True}


def test_batch_promotion_with_a_watermark(spark, tmp_path):
    target = f"{tmp_path}/silver"
    contract = contract_from(ENTRY)
    for file_id, day in (("f1", "2024-02-01"), ("f2", "2024-01-15"), ("f3", "2024-02-02")):
        text = json.dumps(document(file_id, "2024-03-01 00:00:00", [{"symbol": "A", "date": day, "adjClose": "1"}]))
        (tmp_path / f"{file_id}.json").write_text(text)
        promote_batch(spark, B.read_bronze(spark, f"{tmp_path}/{file_id}.json"), contract, target, watermark="date", partition="year")
    assert sorted(str(r.date) for r in spark.read.parquet(target).collect()) == ["2024-02-01", "2024-02-02"]


def test_a_replay_leaves_both_tables_unchanged(spark, tmp_path):
    target, contract = f"{tmp_path}/silver", contract_from(ENTRY)
    text = json.dumps(document("f1", "2024-03-01 00:00:00", [{"symbol": "A", "date": "2024-02-01", "adjClose": "1"}, {"symbol": "B", "date": "bad", "adjClose": None}]))
    (tmp_path / "f1.json").write_text(text)
    seen = []
    for _ in range(3):
        promote_batch(spark, B.read_bronze(spark, f"{tmp_path}/f1.json"), contract, target, partition="month")
        seen.append([sorted(map(str, spark.read.parquet(p).collect())) for p in (target, f"{target}_errors")])
    assert seen[0] == seen[1] == seen[2] and [len(x) for x in seen[0]] == [1, 1]


def test_a_broken_target_is_an_error_and_not_an_empty_one(spark, tmp_path):
    from strataflow.sources.storage import exists

    (tmp_path / "silver").mkdir()
    (tmp_path / "silver" / "part-0.parquet").write_text("no parquet")
    (tmp_path / "f1.json").write_text(json.dumps(document("f1", "2024-03-01 00:00:00", [{"symbol": "A", "date": "2024-02-01", "adjClose": "1"}])))
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        promote_batch(spark, B.read_bronze(spark, f"{tmp_path}/f1.json"), contract_from(ENTRY), f"{tmp_path}/silver")
    assert exists(spark, str(tmp_path)) and not exists(spark, f"{tmp_path}/none")


def test_refresh_keeps_the_version_before_until_the_new_one_is_whole(spark, tmp_path):
    from strataflow.sources.storage import current, refresh

    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        current(spark, path)
    old = refresh(spark.range(3), path)
    with pytest.raises(Exception):
        refresh(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert current(spark, path).count() == 3
    assert refresh(spark.range(7), path).count() == 7 and current(spark, path).count() == 7 and old.count() == 3


def test_reflected_mean(spark):
    score = lambda r: M.scaled(F.lit(2.0), F.lit(0.0), F.lit(9.0), F.lit(5.0), F.lit(1.0), True, reflect_mean=r)
    assert tuple(spark.range(1).select(score(False), score(True)).first()) == (0.0, 1.0)


def test_payload_hash_is_stable_under_key_order(spark):
    a = F.array(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("é")))
    b = F.array(F.create_map(F.lit("b"), F.lit("é"), F.lit("a"), F.lit("1")))
    row = spark.range(1).select(B.payload_hash(a).alias("x"), B.payload_hash(b).alias("y")).first()
    assert row.x == row.y
