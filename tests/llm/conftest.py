import datetime

import pytest
from pyspark.sql import types as T

LONG = "Lorem ipsum dolor sit amet consectetur. " * 5000
EDGE_ROWS = [
    (1, "One two three four five six seven eight nine ten.", "en", "a", 1),
    (1, "One two three four five six seven eight nine ten.", "en", "a", 1),  # repeated
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \n\t\n ", "en", None, 5),
    (None, "no id here, mail a.b@c.de or x", "en", "a", 3),
    (None, None, None, None, None),
    (5, LONG, "la", "b", len(LONG)),
    (6, "x" * 100_000, "en", "a", 100_000),
    (7, "ünï ’s 漢字 🙂\r\nsecond line\n\nlast", "en", "a", 9),
    (8, "One two three four five six seven eight nine ten.", "en", "b", 1),  # a tie
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeats, and columns named like results."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
        T.StructField("n_words", T.DateType()), T.StructField("found", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("bucket", T.StringType()), T.StructField("__id", T.StringType()),
        T.StructField("__gone", T.StringType()), T.StructField("c0", T.StringType()),
        T.StructField("component_id", T.StringType())])
    extra = ("k", datetime.date(2024, 1, 1), None, "f", "n", "b", "i", "g", "c", None)
    return spark.createDataFrame([(*r, *extra) for r in EDGE_ROWS], schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("1 = 0")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
