"""Every registered query of the core against its SQL in DuckDB, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from folioforge.plans import ORACLES, QUERIES
from tools.check_oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    with connect(FOLDER) as con:
        yield con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    problem, _ = compare(spark, duck, FOLDER, name)
    assert problem == ""


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
