import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    # names that the operators use themselves
    T.StructField("id", T.StringType()), T.StructField("row", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("text_key", T.LongType()), T.StructField("score", T.StringType())])


@pytest.fixture()
def docs_of(spark):
    """A documents table with clashing extra columns from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "x", 7, "y", 1, "z") for i, t in rows], DOC_SCHEMA)
    return make


EDGE_ROWS = [(1, None), (2, ""), (3, " \t\n "), (None, "alone without id"), (4, "same text here"), (4, "same text here"),
             (5, "word " * 40_000), (6, "x" * 200_000), (7, "Ünïcode 中文 🙂 <|endoftext|> don't  stop\n\nnow")]


@pytest.fixture()
def edge_docs(docs_of):
    return docs_of(EDGE_ROWS)


@pytest.fixture()
def no_docs(docs_of):
    return docs_of([])
