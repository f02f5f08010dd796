"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest
from compare import assert_equal, duck
from pyspark.sql import functions as F

import __spark_entry__ as driver
from workload import roles
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    with duck(SF_DIR) as opened:
        yield opened


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    result = QUERIES[name](spark, SF_DIR)
    assert assert_equal(result, connection, ORACLES[name]) > 0


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["visit_month", "visits"]
    assert result.count() > 0


def test_torn_text_has_a_file_for_each_input_partition(spark):
    for partitions in (1, 13):
        tables = roles.Tables(spark, "")
        orders = spark.range(2000).selectExpr(
            "id as o_orderkey", "id % 7 as o_custkey", "'O' as o_orderstatus"
        )
        tables["orders"] = orders.repartition(partitions)
        lines = roles.torn_lines(tables).groupBy("file").agg(
            F.count_if("is_header").alias("headers"), F.count("*").alias("lines")
        )
        found = lines.collect()
        assert len(found) == partitions and all(r["headers"] == 1 for r in found)
        assert sum(r["lines"] for r in found) == 2000 + partitions
