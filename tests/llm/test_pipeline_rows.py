"""Stages keep columns whose names the operators use inside, and take null texts, repeated rows and empty tables."""

import pytest
from pyspark.sql import types as T

import corpus_pipeline

NAMES = ("maybe", "n_lines", "n_dropped", "row", "_gone", "_drops", "key")


@pytest.fixture(scope="module")
def docs(spark):
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *[T.StructField(n, T.StringType()) for n in NAMES],
    ])
    line = "a line that more than one document holds"
    texts = [f"{line}\nfirst of all\n", f"{line}\nsecond {'word ' * 30}", None, "", line, "quite another text of its own", "you are an idiot"]
    rows = [(i, t, "en", "s", None if t is None else len(t), *[f"{n} {i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5]], schema)


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_toxic, corpus_pipeline.drop_repeated_lines, corpus_pipeline.keep_one_of_each])
def test_columns_stay(spark, sf, docs, stage):
    got = stage(spark, docs, sf)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {5, 2} <= {r.doc_id for r in rows} and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in NAMES)
    assert stage(spark, docs.limit(0), sf).collect() == []


def test_repeated_lines(spark, sf, docs):
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_lines(spark, docs, sf).collect()}
    assert got[0][0].startswith("a line") and not got[1][0].startswith("a line") and got[1][1] == len(got[1][0])
    assert 4 not in got and got[2] == (None, None)
