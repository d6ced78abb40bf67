"""Every registered query against its SQL, on the smallest data."""

import pytest
from oracle import compare

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, FOLDER, name, QUERIES[name], ORACLES.get(name)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
