"""Table by table, on invented flat rows; one case per known trap."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from invented import configured, flat_rows, plan, rows
from pyspark.sql import functions as F

from dimloom.plans import model as m
from dimloom.plans import tables as t
from dimloom.sources.flat import FLAT_COLUMNS


def build(spark, *cells):
    return m.build_model(flat_rows(spark, *cells))


# The published tables and their columns.
PUBLISHED = {
    "DimPatient": "patient_id patient_first_name patient_last_name patient_date_of_birth "
    "patient_gender patient_address_line1 patient_address_line2 patient_city patient_state "
    "patient_zip patient_phone patient_email patient_status",
    "DimInsurance": "insurance_id patient_id insurance_payer_name insurance_policy_number "
    "insurance_group_number insurance_plan_type",
    "DimBilling": "billing_id insurance_id billing_total_charge billing_amount_paid "
    "billing_date billing_payment_status",
    "DimProvider": "provider_id doctor_name doctor_title doctor_department",
    "DimLocation": "location_id clinic_name room_number",
    "DimPrimaryDiagnosis": "primary_diagnosis_id primary_diagnosis_code primary_diagnosis_desc",
    "DimSecondaryDiagnosis": "secondary_diagnosis_id secondary_diagnosis_code "
    "secondary_diagnosis_desc",
    "DimTreatment": "treatment_id treatment_code treatment_desc",
    "DimPrescription": "prescription_id prescription_drug_name prescription_dosage "
    "prescription_frequency prescription_duration_days",
    "DimLabOrder": "lab_order_id lab_test_code lab_name lab_result_value lab_result_units "
    "lab_result_date",
    "FactVisit": "visit_id patient_id insurance_id billing_id provider_id location_id "
    "primary_diagnosis_id secondary_diagnosis_id treatment_id prescription_id lab_order_id "
    "visit_datetime visit_type",
}


def test_columns_types_and_order_of_the_published_tables(spark):
    model = build(spark, {})
    published = {name: m.published(name, table) for name, table in model.items()}
    assert {n: " ".join(p.columns) for n, p in published.items()} == PUBLISHED
    assert {n: tuple(p.columns) for n, p in published.items()} == t.COLUMNS
    other = {
        f.name: f.dataType.simpleString()
        for p in published.values()
        for f in p.schema
        if f.dataType.simpleString() != "string"
    }
    assert other == {
        "billing_total_charge": "decimal(10,2)",
        "billing_amount_paid": "decimal(10,2)",
        "prescription_duration_days": "int",
        **{spec.id_name: "bigint" for spec in t.NUMBERED},
    }


def test_patient_is_the_latest_record_with_a_status(spark):
    patients = build(
        spark,
        {"patient_id": "p1", "visit_datetime": "2020-01-01 00:00:00.0", "patient_city": "Old"},
        {"patient_id": "p1", "visit_datetime": "2022-01-01 00:00:00.0", "patient_city": "New"},
        {"patient_id": "p2", "visit_datetime": "2021-12-31 23:59:59.9"},
        {"patient_id": "p3", "visit_datetime": "soon"},
        {"patient_id": "p4", "visit_datetime": None},
        {"patient_id": "p4", "visit_datetime": "2021-12-30 00:00:00.0"},
        {"patient_id": None, "visit_datetime": "2023-01-01 00:00:00.0"},
    )["DimPatient"]
    assert rows(patients, "patient_id", "patient_status") == {
        ("p1", "Active"),
        ("p2", "Inactive"),
        ("p3", "Inactive"),
        ("p4", "Inactive"),
        (None, "Inactive"),
    }
    assert patients.filter("patient_id = 'p1'").first()["patient_city"] == "New"


def test_status_from_separate_visits_equals_status_from_the_flat_table(spark):
    flat = flat_rows(
        spark,
        *(
            {
                "patient_id": f"p{i % 5}" if i % 7 else None,
                "visit_datetime": f"20{18 + i % 6}-03-0{1 + i % 9} 00:00:00.0",
            }
            for i in range(40)
        ),
    )
    apart = m.dim_patient(flat.select(*t.PATIENT), flat.select("patient_id", "visit_datetime"))
    assert rows(apart) == rows(m.dim_patient(flat))
    assert rows(m.dim_patient(flat, active_after=dt.date(2100, 1, 1)), "patient_status") == {
        ("Inactive",)
    }


def test_insurance_is_kept_per_patient(spark):
    insurance = build(
        spark,
        {"patient_id": "p1", "insurance_plan_type": "A", "visit_datetime": "2020-01-01 00:00:00.0"},
        {"patient_id": "p1", "insurance_plan_type": "B", "visit_datetime": "2021-01-01 00:00:00.0"},
        {"patient_id": "p2", "insurance_plan_type": "C"},
    )["DimInsurance"]
    assert rows(insurance, "insurance_id", "patient_id", "insurance_plan_type") == {
        ("i1", "p1", "B"),
        ("i1", "p2", "C"),
    }


def test_billing_is_distinct_before_its_time_is_cut(spark):
    flat = flat_rows(
        spark,
        {"billing_date": "2023-05-06 07:08:09.1", "billing_total_charge": "12.345"},
        {"billing_date": "2023-05-06 07:08:09.100", "billing_total_charge": "12.345"},
        {"billing_date": "2023-05-06 07:08:09.2", "billing_total_charge": "12.345"},
        {"billing_payment_status": "Due", "billing_total_charge": "abc"},
    )
    billing = m.published("DimBilling", m.dim_billing(flat))
    shown = [tuple(r)[2:] for r in billing.orderBy(*billing.columns).collect()]
    assert shown == [
        (None, None, "2023-05-06 07:08:09", "Due"),
        (Decimal("12.35"), None, "2023-05-06 07:08:09", "Paid"),
        (Decimal("12.35"), None, "2023-05-06 07:08:09", "Paid"),
    ]
    one = m.billing_one_per_id(flat)
    assert rows(one, "billing_id", "billing_date") == {
        ("b1", dt.datetime(2023, 5, 6, 7, 8, 9, 500000))
    }


def test_numbered_dimensions_are_ordered_by_all_their_columns(spark):
    model = build(
        spark,
        {"doctor_name": "B", "doctor_title": "MD", "room_number": "2"},
        {"doctor_name": "A", "doctor_title": "PA", "room_number": "10"},
        {"doctor_name": "A", "doctor_title": "DO", "room_number": "2"},
        {"doctor_name": "A", "doctor_title": None, "clinic_name": None},
        {"doctor_name": None, "doctor_title": "MD"},
    )
    assert rows(model["DimProvider"], "provider_id", "doctor_name", "doctor_title") == {
        (1, None, "MD"),
        (2, "A", None),
        (3, "A", "DO"),
        (4, "A", "PA"),
        (5, "B", "MD"),
    }
    assert rows(model["DimLocation"]) == {
        (1, None, "101"),
        (2, "North", "10"),
        (3, "North", "101"),
        (4, "North", "2"),
    }


SECONDARY = ("secondary_diagnosis_code", "secondary_diagnosis_desc")


def test_secondary_ids_of_the_fact_are_those_of_the_dimension(spark):
    pairs = [
        (None, None),
        ("D1", None),
        (None, "one"),
        ("", ""),
        ("  ", "one"),
        ("D2", "two"),
        ("D1", "one"),
        ("D1", "other"),
    ]
    model = build(
        spark,
        *(
            {"visit_id": f"v{i}", **dict(zip(SECONDARY, pair, strict=True))}
            for i, pair in enumerate(pairs)
        ),
    )
    assert rows(model["DimSecondaryDiagnosis"]) == {
        (1, "D1", "one"),
        (2, "D1", "other"),
        (3, "D2", "two"),
    }
    found = dict(rows(model["FactVisit"], "visit_id", "secondary_diagnosis_id"))
    assert found == {
        **dict.fromkeys(["v0", "v1", "v2", "v3", "v4"]),
        "v5": 3,
        "v6": 1,
        "v7": 2,
    }


def test_null_tuples_of_the_other_dimensions_are_found(spark):
    model = build(
        spark,
        {"visit_id": "v1", "room_number": None, "treatment_code": None, "treatment_desc": None},
        {"visit_id": "v2"},
    )
    fact = model["FactVisit"]
    assert rows(fact, "visit_id", "location_id", "treatment_id") == {("v1", 1, 1), ("v2", 2, 2)}


def test_prescriptions_and_lab_orders_without_an_id_are_left_out(spark):
    model = build(
        spark,
        {"visit_id": "v1", "prescription_id": "r1", "prescription_duration_days": "7"},
        {"visit_id": "v2", "prescription_id": " ", "lab_order_id": ""},
        {"visit_id": "v3", "lab_order_id": "l1", "lab_result_date": "2023-05-06"},
        {"visit_id": "v4", "lab_order_id": "l1", "lab_result_date": "2023-05-07 01:02:03.9"},
        {"visit_id": "v5", "lab_order_id": "l2", "lab_result_date": "soon"},
    )
    assert rows(model["DimPrescription"], "prescription_id", "prescription_duration_days") == {
        ("r1", 7)
    }
    labs = m.published("DimLabOrder", model["DimLabOrder"])
    assert rows(labs, "lab_order_id", "lab_result_date") == {
        ("l1", "2023-05-07 01:02:03"),
        ("l2", None),
    }
    links = rows(model["FactVisit"], "visit_id", "prescription_id", "lab_order_id")
    assert links == {
        ("v1", "r1", None),
        ("v2", None, None),
        ("v3", None, "l1"),
        ("v4", None, "l1"),
        ("v5", None, "l2"),
    }


def test_fact_keeps_the_latest_record_of_a_visit(spark):
    fact = build(
        spark,
        {"visit_type": "Old", "visit_datetime": "2023-05-06 07:08:09.1"},
        {"visit_type": "New", "visit_datetime": "2023-05-06 07:08:09.2"},
        {"visit_type": "Undated", "visit_datetime": "soon"},
        {"visit_id": None, "visit_type": "No id"},
    )["FactVisit"]
    published = m.published("FactVisit", fact)
    assert rows(published, "visit_id", "visit_type", "visit_datetime") == {
        ("v1", "New", "2023-05-06 07:08:09"),
        (None, "No id", "2023-05-06 07:08:09"),
    }


@pytest.fixture(scope="module")
def many(spark):
    """Two thousand records of 700 visits with ties, nulls and repeats everywhere."""

    def cell(c, choices):
        pick = F.pmod(F.xxhash64("id", F.lit(c)), F.lit(choices + 1))
        return F.when(pick > 0, F.concat(F.lit(c[:3]), pick.cast("string"))).alias(c)

    def day(c):
        pick = F.pmod(F.xxhash64("id", F.lit(c)), F.lit(900)).cast("int")
        moment = F.date_add(F.lit(dt.date(2020, 1, 1)), pick).cast("string")
        return F.concat(moment, F.lit(" 10:00:00.5")).alias(c)

    few = {c: cell(c, 4) for c in FLAT_COLUMNS}
    few |= {c: day(c) for c in ("visit_datetime", "billing_date", "lab_result_date")}
    few |= {
        "visit_id": F.pmod("id", F.lit(700)).cast("string").alias("visit_id"),
        "billing_total_charge": (F.col("id") / 7).cast("string").alias("billing_total_charge"),
    }
    return spark.range(2000).select(*(few[c] for c in FLAT_COLUMNS))


def test_model_does_not_depend_on_the_order_or_partitioning_of_its_input(spark, many):
    first = m.build_model(many.coalesce(1))
    second = m.build_model(many.repartition(8).orderBy(F.rand(2)))
    for name in first:
        assert rows(first[name]) == rows(second[name]), name


def test_invariants_of_a_built_model(spark, many):
    model = m.build_model(many)
    fact = model["FactVisit"]
    assert fact.count() == many.select("visit_id").distinct().count()
    for spec in t.NUMBERED:
        dimension = model[spec.name]
        ids = sorted(r[0] for r in dimension.select(spec.id_name).collect())
        assert ids == list(range(1, len(ids) + 1))
        assert dimension.select(*spec.keys).distinct().count() == len(ids)
        unknown = fact.filter(F.col(spec.id_name).isNotNull()).join(
            dimension, spec.id_name, "left_anti"
        )
        assert unknown.count() == 0
        if not spec.drop_blank:
            assert fact.filter(F.col(spec.id_name).isNull()).count() == 0


def test_each_fact_row_is_one_input_row(spark, many):
    model = m.build_model(many)
    wide = model["FactVisit"]
    for spec in t.NUMBERED:
        wide = wide.join(model[spec.name], spec.id_name, "left")
    columns = [c for c in many.columns if c in wide.columns and c != "visit_datetime"]
    secondary = [c for c in columns if c.startswith("secondary")]
    columns = [c for c in columns if c not in secondary]
    assert wide.select(*columns).subtract(many.select(*columns)).count() == 0


def test_fact_looks_ids_up_by_broadcast_and_shuffles_once(spark, many, tmp_path):
    many.write.parquet(str(tmp_path / "flat"))
    fact = m.build_model(spark.read.parquet(str(tmp_path / "flat")))["FactVisit"]
    text = plan(fact)
    tree = text[: text.index("\n\n")]
    # A lookup for each numbered dimension, whose ids are joined from the offsets of its ranges.
    assert tree.count("BroadcastHashJoin") == 2 * len(t.NUMBERED)
    assert tree.count("SortMergeJoin") == 0
    # One by visit; and two over the counts of the ranges of each numbered dimension.
    assert tree.count("WindowGroupLimit") == 2
    exchanges = tree.count("Exchange (") - tree.count("BroadcastExchange (")
    assert exchanges == 1 + 2 * len(t.NUMBERED)


def test_duplicates_go_before_ids_are_looked_up(spark, many, tmp_path):
    """Without broadcast, the lookups shuffle one record per visit."""
    many.write.parquet(str(tmp_path / "flat"))
    with configured(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(m.build_model(spark.read.parquet(str(tmp_path / "flat")))["FactVisit"])
    tree = text[: text.index("\n\n")]
    assert tree.count("SortMergeJoin") == 5
    assert tree.rindex("SortMergeJoin") < tree.index("WindowGroupLimit")


def test_each_dimension_reads_only_its_columns(spark, many, tmp_path):
    many.write.parquet(str(tmp_path / "flat"))
    flat = spark.read.parquet(str(tmp_path / "flat"))
    text = plan(m.dim_prescription(flat))
    schema = text[text.index("ReadSchema:") :].splitlines()[0]
    assert "patient" not in schema and schema.count(":") - 1 == 6
    assert "Filter" in text
