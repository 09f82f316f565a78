import pytest
from pyspark.sql import types as T


@pytest.fixture
def docs_of(spark):
    """A documents-like table, with extra columns whose names clash with those that operators use."""

    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = [f"src{i % 3}" for i in range(len(texts))] if sources is None else sources
        rows = [(i, t, "en", s, None if t is None else len(t), "x", 7, "y") for i, t, s in zip(ids, texts, sources)]
        fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
                  ("n_chars", T.LongType()), ("ids", T.StringType()), ("rid", T.LongType()), ("score", T.StringType())]
        return spark.createDataFrame(rows, T.StructType([T.StructField(n, t) for n, t in fields]))

    return make
