"""The registered corpus queries against their SQL twins, and the registration itself."""

import re

import oracle
import pytest

from threadloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    import __spark_entry__ as entry

    names = entry.queries()
    numbers = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14))
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    problem = oracle.difference(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLES[name])
    assert problem is None, problem
