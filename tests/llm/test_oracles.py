"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

from dimloom.llm.queries import ORACLES, QUERIES
from tests.compare import assert_equal, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    with duck(SF_DIR) as connection:
        assert assert_equal(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) > 0
