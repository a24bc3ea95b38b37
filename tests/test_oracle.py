"""Every registered query equals its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from siltline.plans import registry
from tests import oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, sf, name):
    assert oracle.compare(spark, con, name, sf) > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["pickup_day", "vendor", "total_revenue"]
