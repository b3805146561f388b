"""Every named query against its SQL on the same files."""

import pytest

import __spark_entry__ as contract
import oracle
from fareloom.plans import registry

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_gives_rows(spark, sf_dir):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, con, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None
