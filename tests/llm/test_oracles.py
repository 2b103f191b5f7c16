"""Queries that SQL can express against their SQL in DuckDB."""

import pytest

from folioforge.llm.plans import LLM_ORACLES, LLM_QUERIES
from tools.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    assert name in LLM_QUERIES
    with connect(FOLDER) as duck:
        problem, rows = compare(spark, duck, FOLDER, name)
    assert problem == "" and rows > 0
