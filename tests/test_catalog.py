"""Every registered query against its SQL twin, on whole tables."""

import oracle
import pytest

from threadloom.plans.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    problem = oracle.difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    rows = driver.entry(spark)
    assert rows.columns == ["input_text", "target_text", "company"]
    assert rows.count() > 0
