import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], *(list(r[2:]) + ["en", "s"][len(r) - 2:]), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make
