import pytest
from pyspark.sql import functions as F

from strataflow.llm import language_id as L


@pytest.fixture(scope="module")
def profiles(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return L.learn_profiles(L.training_rows(docs), "doc_id", "text", "lang")


def test_held_out_accuracy(spark, sf, profiles):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    said = L.identify(docs, profiles).where(L.held_out() & F.col("lang").isNotNull()).collect()
    right = sum(r.lang == r.lang_pred for r in said)
    assert len(said) > 20 and right >= 0.9 * len(said)


def test_edge_cases(documents, profiles):
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, "x"), (5, "the of and " * 50_000), (None, "der die das und")]
    got = {r.doc_id: r for r in L.identify(documents(rows).withColumn("note", F.lit("mine")), profiles).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and [got[i].score for i in (1, 2, 3)] == [0.0] * 3
    assert got[5].lang_pred == "en" and got[None].lang_pred == "de" and got[4].note == "mine"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_no_labels_and_no_rows(documents):
    frame = documents([(1, "abc")])
    none = L.learn_profiles(L.training_rows(frame), "doc_id", "text", "lang")
    assert none == {} and L.identify(frame, none).first().lang_pred == "und"
    assert L.identify(documents([]), none).count() == 0


def test_out_of_place_distance_by_hand():
    import numpy as np

    pack = lambda s: sum(ord(c) << 21 * i for i, c in enumerate(s))
    judge = L.Profiles({"a": np.array([pack("a"), pack(" a")], np.uint64), "b": np.array([pack("b"), pack("a")], np.uint64)}, doc_size=3)
    lang, score = judge.predict("a")  # own order: " a", " a ", "a", "a " by code, cut at three
    own = sorted([pack("a"), pack(" a"), pack("a "), pack(" a ")])[:3]
    ranks = {"a": {pack("a"): 0, pack(" a"): 1}, "b": {pack("b"): 0, pack("a"): 1}}
    apart = {k: sum(abs(v[g] - i) if g in v else 2 for i, g in enumerate(own)) for k, v in ranks.items()}
    assert lang == min(apart, key=apart.get) and score == pytest.approx(1 - min(apart.values()) / 6)


def test_columns_named_like_results_and_dotted(documents, profiles):
    frame = documents([(1, "der die das und"), (2, None)]).withColumns({"score": F.lit("mine"), "a.b": F.lit(1), "text_": F.lit(2)})
    kept = L.identify(frame, profiles, names=("said", "sure"))
    assert kept.columns == [*frame.columns, "said", "sure"] and [(r.score, r.said) for r in kept.orderBy("doc_id").collect()] == [("mine", "de"), ("mine", "und")]
    assert L.identify(frame, profiles).columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "text_", "lang_pred", "score"]
