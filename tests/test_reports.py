from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from invented import flat_rows, rows

from dimloom.plans import model as m
from dimloom.plans import reports


@pytest.fixture(scope="module")
def model(spark):
    cells = [
        ("v1", "p1", "2023-01-31 23:59:59.9", "North", "Dr A", "Eyes", "A"),
        ("v2", "p1", "2023-02-01 00:00:00.0", "North", "Dr A", "Eyes", "A"),
        ("v3", "p2", "2023-02-10 00:00:00.0", "South", "Dr A", "Ears", "B"),
        ("v4", "p2", "2023-02-11 00:00:00.0", None, "Dr B", "Ears", "A"),
    ]
    return m.build_model(
        flat_rows(
            spark,
            *(
                {
                    "visit_id": visit,
                    "patient_id": patient,
                    "patient_gender": {"p1": "F", "p2": "M"}[patient],
                    "visit_datetime": when,
                    "billing_id": visit,
                    "billing_date": when,
                    "billing_total_charge": "1.10",
                    "clinic_name": clinic,
                    "doctor_name": doctor,
                    "doctor_department": department,
                    "visit_type": kind,
                }
                for visit, patient, when, clinic, doctor, department, kind in cells
            ),
        )
    )


def test_monthly_visits(model):
    assert rows(reports.monthly_visits(model["FactVisit"])) == {
        (dt.datetime(2023, 1, 1), 1),
        (dt.datetime(2023, 2, 1), 3),
    }


def test_visits_by_clinic_and_type(model):
    assert rows(reports.visits_by_clinic_and_type(model)) == {
        ("North", "A", 2),
        ("South", "B", 1),
        (None, "A", 1),
    }


def test_visits_by_department_and_gender(model):
    by_gender = reports.visits_by_provider_and_gender(model)
    assert rows(by_gender) == {("F", "Eyes", 2), ("M", "Ears", 2)}
    wide = reports.gender_columns(by_gender, ["F", "M"])
    assert rows(wide, "doctor_department", "F", "M") == {("Eyes", 2, None), ("Ears", None, 2)}


def test_billing_accumulates_over_months(model):
    assert rows(reports.billing_by_month(model["DimBilling"])) == {
        (dt.datetime(2023, 1, 1), Decimal("1.10"), Decimal("1.10")),
        (dt.datetime(2023, 2, 1), Decimal("3.30"), Decimal("4.40")),
    }


def test_visits_by_doctor(model):
    assert rows(reports.visits_by_doctor(model)) == {
        ("Dr A", "Eyes", 2),
        ("Dr A", "Ears", 1),
        ("Dr B", "Ears", 1),
    }
