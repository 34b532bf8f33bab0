"""Fixtures for the training-data operators."""

import pytest
from pyspark.sql import types as T

#: A documents table with clashing extra columns.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("h", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("row", T.StringType()),
])


@pytest.fixture()
def documents(spark):
    """Frame of (doc_id, text) or (doc_id, text, lang) rows, with extra columns."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1]) if r[1] is not None else None, "x", None, 0.5, "y") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
