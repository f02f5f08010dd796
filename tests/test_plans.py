"""Plans of the registered queries, looked at before they run."""

from __future__ import annotations

import pytest
from invented import configured, plan

from workload.queries import NUMBERED_QUERIES, QUERIES, written_model

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_leaves_the_jvm_or_pairs_all_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "Cartesian", "NestedLoop", "CollectLimit", "GlobalLimit"):
        assert operator not in text, operator


ONE_ROW_PER_TABLE = {
    "normalized_counts", "model_row_counts", "pk_null_counts", "parse_rejects_mixed_times",
    "input_key_profile", "blank_keys_profile", "blank_keys_pk_nulls", "blank_keys_report",
    "fk_summary", "fanout_check", "insurance_fan_out", "quality_report", "exported_quality",
    "exported_quality_torn", "line_breaks_left_out", "quality_in_batches",
}
ONE_ROW_PER_MONTH = {"billing_running_total", "billing_running_total_conflicts"}
# Ids are counted on from range to range.
ONE_ROW_PER_RANGE = {
    name + source
    for name in (*NUMBERED_QUERIES, "fact_visit")
    for source in ("", "_from_flat")
} | {"fact_visit_mixed_times", "blank_keys_fact", "blank_keys_fk_nulls", "part_supplier_ids"}
ONE_ROW_PER_RANGE |= {"pair_ids_after_append"}
ONE_ROW_EACH = ONE_ROW_PER_TABLE | ONE_ROW_PER_MONTH | ONE_ROW_PER_RANGE


@pytest.mark.parametrize("name", QUERIES)
def test_single_partitions_hold_only_aggregates(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert ("SinglePartition" in text) == (name in ONE_ROW_EACH)


@pytest.mark.parametrize("name", ["visits_by_location_type", "provider_activity"])
def test_reports_count_before_they_join_even_without_broadcast(spark, name):
    """With nothing small enough to broadcast, hot ids are still one row at the shuffle."""
    written_model(spark, SF_DIR)
    with configured(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name](spark, SF_DIR))
    tree = text[: text.index("\n\n")]
    assert "SortMergeJoin" in tree
    assert tree.rindex("HashAggregate") > tree.rindex("SortMergeJoin")


@pytest.mark.parametrize("name", ["visits_by_department_gender", "gender_columns"])
def test_no_counts_of_provider_and_patient_are_shuffled(spark, name):
    """The small dimension is joined first; what is shuffled is counted by its attribute."""
    text = plan(QUERIES[name](spark, SF_DIR))
    tree = text[: text.index("\n\n")]
    assert "hashpartitioning(provider_id" not in text
    assert "hashpartitioning(doctor_department" in text
    lowest = tree.rindex("Join")
    assert tree[:lowest].endswith("BroadcastHash") and tree.rindex("HashAggregate") < lowest


def test_reports_read_only_the_columns_they_use(spark):
    text = plan(QUERIES["monthly_visits"](spark, SF_DIR))
    assert "ReadSchema: struct<visit_datetime:timestamp_ntz>" in text


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["fk_orphan_rows"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(lab_order_id)]" in text


def test_quality_reads_usage_that_is_counted_once(spark):
    text = plan(QUERIES["quality_report"](spark, SF_DIR))
    tree = text[: text.index("\n\n")]
    # The usage of eleven tables' keys, and patients for their status.
    assert tree.count("Scan parquet") == 12
    assert "Join" not in tree
