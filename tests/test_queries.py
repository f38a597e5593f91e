"""Every query against its SQL on the smallest tables."""

import pytest

from spotloom import registry

from .oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    assert_same(registry.QUERIES[name](spark, sf_dir), con, registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_queries_without_sql_have_rows(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_points():
    import __spark_entry__ as e

    assert set(registry.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
