"""What the tables are: names, columns, keys and links."""

from __future__ import annotations

from dataclasses import dataclass

# The flat input's column names by subject, and the names, columns and column
# order of the published tables.
PATIENT = (
    "patient_id",
    "patient_first_name",
    "patient_last_name",
    "patient_date_of_birth",
    "patient_gender",
    "patient_address_line1",
    "patient_address_line2",
    "patient_city",
    "patient_state",
    "patient_zip",
    "patient_phone",
    "patient_email",
)
VISIT = ("visit_id", "visit_datetime", "visit_type")
INSURANCE = (
    "insurance_id",
    "insurance_payer_name",
    "insurance_policy_number",
    "insurance_group_number",
    "insurance_plan_type",
)
BILLING = (
    "billing_id",
    "billing_total_charge",
    "billing_amount_paid",
    "billing_date",
    "billing_payment_status",
)
PROVIDER = ("doctor_name", "doctor_title", "doctor_department")
LOCATION = ("clinic_name", "room_number")
PRIMARY_DIAGNOSIS = ("primary_diagnosis_code", "primary_diagnosis_desc")
SECONDARY_DIAGNOSIS = ("secondary_diagnosis_code", "secondary_diagnosis_desc")
TREATMENT = ("treatment_code", "treatment_desc")
PRESCRIPTION = (
    "prescription_id",
    "prescription_drug_name",
    "prescription_dosage",
    "prescription_frequency",
    "prescription_duration_days",
)
LAB_ORDER = (
    "lab_order_id",
    "lab_test_code",
    "lab_name",
    "lab_result_value",
    "lab_result_units",
    "lab_result_date",
)
FACT_VISIT = (
    "visit_id",
    "patient_id",
    "insurance_id",
    "billing_id",
    "provider_id",
    "location_id",
    "primary_diagnosis_id",
    "secondary_diagnosis_id",
    "treatment_id",
    "prescription_id",
    "lab_order_id",
    "visit_datetime",
    "visit_type",
)


@dataclass(frozen=True)
class Numbered:
    """A dimension that is the distinct tuples of some columns under a dense id."""

    name: str
    id_name: str
    keys: tuple[str, ...]
    drop_blank: bool = False  # leave out tuples with any blank part; the fact then has no id


@dataclass(frozen=True)
class Link:
    """Columns of the fact that refer to a dimension's key of the same names."""

    dimension: str
    columns: tuple[str, ...]


# The published tables' ids, keys and moments.
NUMBERED = (
    Numbered("DimProvider", "provider_id", PROVIDER),
    Numbered("DimLocation", "location_id", LOCATION),
    Numbered("DimPrimaryDiagnosis", "primary_diagnosis_id", PRIMARY_DIAGNOSIS),
    Numbered(
        "DimSecondaryDiagnosis", "secondary_diagnosis_id", SECONDARY_DIAGNOSIS, drop_blank=True
    ),
    Numbered("DimTreatment", "treatment_id", TREATMENT),
)

FACT = "FactVisit"

# Table name -> primary key columns, in the order the tables are reported.
PRIMARY_KEYS = {
    "DimPatient": ("patient_id",),
    "DimInsurance": ("insurance_id", "patient_id"),
    "DimBilling": ("billing_id",),
    **{n.name: (n.id_name,) for n in NUMBERED},
    "DimPrescription": ("prescription_id",),
    "DimLabOrder": ("lab_order_id",),
    FACT: ("visit_id",),
}

# Table name -> the key columns its rows have in the flat input.
NATURAL_KEYS = PRIMARY_KEYS | {n.name: n.keys for n in NUMBERED}

LINKS = tuple(Link(name, key) for name, key in PRIMARY_KEYS.items() if name != FACT)

# Table name -> published columns, in order.
COLUMNS = {
    "DimPatient": (*PATIENT, "patient_status"),
    "DimInsurance": ("insurance_id", "patient_id", *INSURANCE[1:]),
    "DimBilling": ("billing_id", "insurance_id", *BILLING[1:]),
    **{n.name: (n.id_name, *n.keys) for n in NUMBERED},
    "DimPrescription": PRESCRIPTION,
    "DimLabOrder": LAB_ORDER,
    FACT: FACT_VISIT,
}

# Columns that are timestamps inside and text cut to seconds when published.
MOMENTS = {
    "DimBilling": "billing_date",
    "DimLabOrder": "lab_result_date",
    FACT: "visit_datetime",
}
