"""Every registered query against its SQL."""

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as contract
from skyledger.workload.oracles import ORACLES
from skyledger.workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    got = spark_rows(contract.queries()[name](spark, SF))
    want = duck_rows(con, contract.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_entry(spark):
    assert contract.entry(spark).count() > 0
