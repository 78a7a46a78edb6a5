import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with a column that clashes with names the operators use inside."""

    def make(rows):
        schema = T.StructType([
            T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
            T.StructField("source", T.StringType()), T.StructField("id", T.StringType()), T.StructField("size", T.StringType()),
        ])
        return spark.createDataFrame([(d, t, s, "x", None) for d, t, s in rows], schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long_ = " ".join(f"word{i % 977}" for i in range(60_000))
    return [
        (1, "One two three four five.\nA line that is long enough to count.", "a"), (2, None, "a"), (3, "", None), (4, long_, "b"),
        (5, long_, "b"), (6, " \t\n ", "b"), (7, "you are an idiot", None), (7, "you are an idiot", None), (None, "no key here at all", "c"),
        (None, None, None), (8, "One  two three four\tfive.\nA line that is long enough to count.", "é"),
    ]
