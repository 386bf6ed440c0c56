"""Every query with an oracle against DuckDB, the others for a stable result."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SLOW = {"M7_gradient_boosting", "M8_second_boosting", "M11_compare_models", "M5_logistic_regression",
        "L5_compare_classification_models", "L6_run_all"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, sf_dir, con, name):
    sql = entry.oracle_sql().get(name)
    assert difference(spark, con, sf_dir, name, entry.queries()[name], sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
