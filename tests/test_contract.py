"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from contract.oracle import ORACLES
from contract.queries import QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(contract.queries()[name](spark, FOLDER), contract.oracle_sql()[name], con) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["mer_no", "total"]
