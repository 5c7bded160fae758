import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark):
    """A documents table of texts, or of (doc_id, text, source) rows."""

    def make(rows):
        rows = [(at, row, "s") if row is None or isinstance(row, str) else row for at, row in enumerate(rows)]
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
