"""Every registered query against its SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as contract
from workload.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_job_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert len(contract.entry(spark).columns) == 23


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert difference(QUERIES[name](spark, SF), ORACLE[name], db) is None
