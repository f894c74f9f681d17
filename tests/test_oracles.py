"""Every query with SQL against DuckDB, over whole tables."""

import pytest

from fjordmill.plans import registry
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, sf, con, name):
    assert compare(registry.queries()[name](spark, sf), con, registry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
