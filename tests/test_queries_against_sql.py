"""Every registered query gives the rows of its SQL twin."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from loanloom.plans.catalogue import REGISTRY as QUERIES
from loanloom.plans.checks import CHECKS, check_sql

ORACLE = {key: check_sql(key) for key in CHECKS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(key, spark, con, sf_dir):
    message, rows = differences(spark, con, QUERIES[key], ORACLE[key], sf_dir)
    assert message is None, message
    assert rows > 0


def test_entry_registers_them_all():
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


def test_entry_runs(spark):
    assert entry.entry(spark).columns == [
        "product_type", "decision_month", "decision_outcome", "decision_count", "pct_of_month",
    ]
