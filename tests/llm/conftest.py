import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """make(rows of (id, text)) -> a documents table; rows may also give lang and source."""

    def make(rows, **extra):
        data = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(data, DOCS)

    return make
