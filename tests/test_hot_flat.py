"""All tables from a flat table in which every kind of key has a hot or missing third."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from compare import assert_equal
from invented import configured, plan
from pyspark.sql import functions as F

from dimloom.plans import model as m
from dimloom.plans import tables as t
from dimloom.sources.flat import FLAT_COLUMNS
from workload import oracles, roles
from workload.queries import ACTIVE_AFTER

ABSENT = {
    "patient_id",
    "doctor_title",
    "room_number",
    "secondary_diagnosis_desc",
    "treatment_code",
    "prescription_id",
    "lab_order_id",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the rows share each column's value, picked anew per column; some have none."""

    def cell(c):
        draw = F.pmod(F.xxhash64("visit_id", "l_row", F.lit(c)), F.lit(30))
        value = F.when(draw < 10, F.lit("2000-02-29 12:00:00.25" if "date" in c else "7"))
        if c in ABSENT:
            value = value.when(draw < 13, F.lit(None)).when(draw < 15, "").when(draw < 17, "  ")
        if c in ("visit_datetime", "billing_date", "billing_total_charge"):
            value = value.when(draw < 12, "unreadable")
        return value.otherwise(F.col(c)).alias(c)

    path = str(tmp_path_factory.mktemp("hot") / "flat")
    flat = roles.flat(roles.Tables(spark, "/root/testdata/sf0.01"))
    numbered = flat.withColumn("l_row", F.monotonically_increasing_id())
    numbered.select(*(cell(c) for c in FLAT_COLUMNS)).repartition(6).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def tables(spark, hot):
    return m.build_model(spark.read.parquet(hot), ACTIVE_AFTER)


@pytest.mark.parametrize("name", t.PRIMARY_KEYS)
def test_table_equals_sql(hot, tables, name):
    with duckdb.connect() as connection:
        connection.execute(f"create view flat as select * from '{hot}/*.parquet'")
        shown = oracles.published(name, name)
        sql = f"with {oracles.model_tables(flat="flat")} {shown}"
        assert assert_equal(m.published(name, tables[name]), connection, sql) > 0


def test_fact_splits_hot_tuples_when_no_dimension_can_be_broadcast(spark, hot, tables):
    """All five lookups as sort-merge joins; the partitions of hot tuples get several tasks."""
    with configured(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive_autoBroadcastJoinThreshold="-1",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="100KB",
        adaptive_skewJoin_skewedPartitionFactor="1.5",
        adaptive_advisoryPartitionSizeInBytes="100KB",
    ):
        fact = m.build_model(spark.read.parquet(hot), ACTIVE_AFTER)[t.FACT]
        merged = Counter(fact.collect())
        tree = plan(fact).partition("\n\n")[0].partition("== Initial Plan ==")[0]
    assert merged == Counter(tables[t.FACT].collect())
    assert tree.count("SortMergeJoin") == 5
    assert tree.count("SortMergeJoin(skew=true)") >= 3
