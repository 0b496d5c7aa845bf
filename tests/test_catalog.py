"""Every named query against its SQL counterpart, on the smallest test tables."""

import pytest

import __spark_entry__ as contract
import check_oracle
from planact.catalog import CATALOG

SF = "/root/testdata/sf0.001"

#: Queries that list what is wrong; the test tables may hold nothing of the kind.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, con, name):
    problem = check_oracle.compare(spark, con, SF, name)
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY)


def test_every_query_has_a_counterpart():
    assert {name for name, item in CATALOG.items() if item.sql is None} == set()
    assert set(CATALOG) <= set(contract.queries())
    assert not set(contract.oracle_sql()) - set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["version", "day"] and not df.isEmpty()
