"""The pipeline's stages on the smallest tables, against plain versions."""

import collections

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from strataflow.llm import language_id

from .test_exact_dedup import brute
from .test_near_copies import brute as near_groups


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The documents, and what each stage left of them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf).persist())
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_keep_the_columns_of_documents(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "mixing", "BPE"]
    assert all(x.columns == steps[0].columns for x in steps[:-1])


def test_language_keeps_what_has_words(steps):
    kept = {i for i, _ in texts(steps[1])}
    assert all(i in kept for i, t in texts(steps[0]) if t and sum(c.isalpha() for c in t) > 20)


def test_language_drops_what_has_none(spark, sf, documents):
    frame = documents([(1, "12 34 !"), (2, None), (3, "the of and to in is that for it")]).withColumn("lang", F.lit("en"))
    assert [r.doc_id for r in corpus_pipeline.language(spark, frame, sf).collect()] == [3]


def test_exact_and_near(steps):
    """Near copies by brute force over all pairs: five-word shingles, similarity of 0.8 or more, the rule for stages."""
    before = texts(steps[1])
    assert sorted(i for i, _ in texts(steps[2])) == sorted(r[0] for r in brute(before) if r[3])
    assert sorted(i for i, _ in texts(steps[3])) == sorted(min(i for i, _ in g) for g in near_groups(texts(steps[2])))


def test_mixing_and_tokens(spark, sf, steps):
    copies = collections.Counter(i for i, _ in texts(steps[4]))
    assert max(copies.values()) <= 3 and set(copies) <= {i for i, _ in texts(steps[3])}
    tokens = collections.Counter(r.doc_id for r in steps[5].collect())
    assert tokens == copies
    assert corpus_pipeline.run(spark, sf).count() == sum(copies.values())


def test_nulls_ties_and_empty(spark, sf, documents):
    rows = [(1, None), (2, ""), (None, "the of and to in is that for it"), (4, "the of and  to in is that for it"), (4, "the of and  to in is that for it")]
    for frame in (documents(rows).withColumn("lang", F.lit("en")), documents([])):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, sf).persist()
        assert frame.count() in (0, 1, 2, 3)
    assert language_id.UNKNOWN == "und"


def test_any_column_names_reach_the_end(spark, sf, documents):
    rows = [(1, "the of and to in is that for it"), (2, "the of and to in  is that for it"), (None, "der die das und ist in nicht ein zu"), (7, "que la de el en los por una"), (7, "the and of is to for that in it")]
    names = ("score", "lang_pred", "key", "unit", "copies", "a.b", "__size", "node", "text_")
    frame = documents(rows).withColumn("lang", F.lit("en")).withColumns({n: F.lit("mine") for n in names})
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, stage(spark, frame, sf).persist()
        assert name == "BPE" or (frame.columns == before.columns and all(r[n] == "mine" for r in frame.collect() for n in names))
    assert frame.count() > 0
