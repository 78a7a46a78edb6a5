"""Every registered query against its SQL on the smallest folder."""

import pytest

import __spark_entry__ as entry
from check import compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    ok, text, _ = compare(spark, sf, name, QUERIES[name], ORACLES.get(name))
    assert ok, text


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
