"""Reporting queries over the model.

Visits are counted per id before a dimension's attributes are joined, so the joins see one row
per id, whatever share of the visits an id has; of two dimensions the small one is joined first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.operators.dedup import one_per_key
from dimloom.plans.tables import FACT


def _month(moment: str) -> Column:
    """First moment of the month."""
    return F.date_trunc("month", F.col(moment)).cast("timestamp_ntz")


def monthly_visits(fact: DataFrame) -> DataFrame:
    return fact.groupBy(_month("visit_datetime").alias("visit_month")).agg(
        F.count("*").alias("visits")
    )


def visits_by(
    counted: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Swap an id for attributes of its dimension, in a table of visit counts."""
    others = [c for c in counted.columns if c not in (key, "visits")]
    described = counted.join(dimension.select(key, *attributes), key, "left")
    return described.groupBy(*attributes, *others).agg(F.sum("visits").alias("visits"))


def visits_by_clinic_and_type(model: Mapping[str, DataFrame]) -> DataFrame:
    counted = model[FACT].groupBy("location_id", "visit_type").agg(F.count("*").alias("visits"))
    return visits_by(counted, model["DimLocation"], "location_id", ["clinic_name"])


def visits_by_provider_and_gender(
    model: Mapping[str, DataFrame], attribute: str = "doctor_department"
) -> DataFrame:
    """The provider's attribute is swapped in before anything is counted: there are few of its
    values, so counts by it and the patient reduce the visits, while almost every visit has a
    provider and patient of its own. The patients, who may be many, are joined to those counts."""
    provider = model["DimProvider"].select("provider_id", attribute)
    described = model[FACT].select("provider_id", "patient_id").join(provider, "provider_id", "left")
    counted = described.groupBy(attribute, "patient_id").agg(F.count("*").alias("visits"))
    return visits_by(counted, model["DimPatient"], "patient_id", ["patient_gender"])


def gender_columns(visits: DataFrame, genders: Sequence[str]) -> DataFrame:
    """The same counts with one column per given gender value, ``other`` for the visits of all
    other values and of none, and ``visits`` for their sum."""
    rows = [c for c in visits.columns if c not in ("patient_gender", "visits")]
    gender, count = F.col("patient_gender"), F.col("visits")
    listed = F.coalesce(gender.isin(list(genders)), F.lit(False))
    return visits.groupBy(*rows).agg(
        *(F.sum(F.when(gender == value, count)).alias(value) for value in genders),
        F.sum(F.when(~listed, count)).alias("other"),
        F.sum(count).alias("visits"),
    )


def billing_by_month(billing: DataFrame) -> DataFrame:
    """Charges per month and their running total; billings without a date come first.

    A billing recorded in several states counts once, by its latest record; records without a
    billing id count each. The window is global but holds one row per calendar month.
    """
    own = F.when(F.col("billing_id").isNull(), F.monotonically_increasing_id())
    latest = one_per_key(
        billing.withColumn("_own", own), ["billing_id", "_own"], newest_by=["billing_date"]
    )
    monthly = latest.groupBy(_month("billing_date").alias("billing_month")).agg(
        F.sum("billing_total_charge").cast("decimal(28,2)").alias("month_total")
    )
    so_far = Window.orderBy(F.col("billing_month").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = F.sum("month_total").over(so_far).cast("decimal(28,2)")
    return monthly.withColumn("running_total", running)


def visits_by_doctor(model: Mapping[str, DataFrame]) -> DataFrame:
    counted = model[FACT].groupBy("provider_id").agg(F.count("*").alias("visits"))
    return visits_by(
        counted, model["DimProvider"], "provider_id", ["doctor_name", "doctor_department"]
    )
