"""Registered queries against their checking SQL, on the smallest tables."""

import pytest

import __spark_entry__ as e
from check_queries import compare, engine


@pytest.fixture(scope="module")
def con(sf_dir):
    return engine(sf_dir)


@pytest.mark.parametrize("name", sorted(e.queries()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, e.queries()[name], e.oracle_sql().get(name), sf_dir) is None


def test_every_oracle_has_its_query():
    assert set(e.oracle_sql()) <= set(e.queries())
