"""Every named query against its SQL on DuckDB, over whole tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from wattlake.plans import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    problem = compare(spark, duck, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_the_entry_query_runs(spark):
    if not os.path.isdir(entry.SMOKE_DIR):
        pytest.skip("no smoke tables")
    assert entry.entry(spark).count() > 0
