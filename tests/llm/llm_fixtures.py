import pytest
from pyspark.sql import types as T

from corvid.llm.registry import reach_package

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(autouse=True)
def package(spark):
    reach_package(spark)


@pytest.fixture
def docs(spark):
    """(id, text) pairs -> a documents table; null ids, null texts and repeated rows welcome."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)
    return make
