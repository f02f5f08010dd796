"""Building the ten dimensions and the fact.

Builders take any DataFrame that has the flat input's text columns they need, so a source can
be the one flat table or a frame of its own per table. Dates and amounts are typed inside the
model; ``published`` gives the text layout of the written tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.functions import cells
from dimloom.operators.dedup import one_per_key
from dimloom.operators.keys import (
    dense_ids,
    dense_ids_together,
    looked_up_by_broadcast,
    lookup_id,
)
from dimloom.plans import tables as t
from dimloom.plans.tables import (
    FACT,
    FACT_VISIT,
    MOMENTS,
    NUMBERED,
    PRIMARY_KEYS,
    Numbered,
)

_SEEN = "_seen"  # helper column: when a row was recorded
_OWN = "_own"  # helper column: tells records without an id apart


def _visit_time() -> Column:
    return cells.parse_timestamp(F.col("visit_datetime"), *cells.MOMENT_PATTERNS)


def _with_keys(source: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Blank keys as null, before anything is grouped, joined or counted by them."""
    present = [k for k in keys if k in source.columns]
    return source.withColumns({k: cells.filled(F.col(k)) for k in present})


def _newest(source: DataFrame, columns: tuple[str, ...], keys: tuple[str, ...]) -> DataFrame:
    """The latest visit's row per key, or just the greatest row where visits have no time."""
    if "visit_datetime" not in source.columns:
        return one_per_key(source.select(*columns), keys)
    timed = source.select(*columns, _visit_time().alias(_SEEN))
    return one_per_key(timed, keys, newest_by=[_SEEN])


def last_visits(visits: DataFrame) -> DataFrame:
    """The day of each patient's last visit."""
    day = _visit_time().cast("date")
    visits = _with_keys(visits, ["patient_id"])
    return visits.groupBy("patient_id").agg(F.max(day).alias("last_visit_date"))


def dim_patient(
    source: DataFrame,
    visits: DataFrame | None = None,
    active_after: dt.date = cells.ACTIVE_AFTER,
) -> DataFrame:
    """One row per patient with a status from the last visit.

    From the flat table the surviving row is the patient's latest, so its own time is the last
    visit and one pass is enough. With ``visits`` kept apart, the two are joined. Either way
    the row of records without a patient id has no last visit.
    """
    source = _with_keys(source, ["patient_id"])
    if visits is None:
        patients = _newest(source, t.PATIENT, ("patient_id",))
        last_visit = F.when(F.col("patient_id").isNotNull(), F.col(_SEEN))
    else:
        patients = one_per_key(source.select(*t.PATIENT), ["patient_id"]).join(
            last_visits(visits), "patient_id", "left"
        )
        last_visit = F.col("last_visit_date")
    status = cells.activity_status(last_visit, active_after).alias("patient_status")
    return patients.select(*t.PATIENT, status)


def dim_insurance(source: DataFrame) -> DataFrame:
    columns, keys = t.COLUMNS["DimInsurance"], PRIMARY_KEYS["DimInsurance"]
    return _newest(_with_keys(source, keys), columns, keys).select(*columns)


def _billing(source: DataFrame) -> DataFrame:
    moment = cells.parse_timestamp(F.col("billing_date"), *cells.MOMENT_PATTERNS)
    return _with_keys(source, ["billing_id", "insurance_id"]).select(
        "billing_id",
        "insurance_id",
        cells.parse_amount(F.col("billing_total_charge")).alias("billing_total_charge"),
        cells.parse_amount(F.col("billing_amount_paid")).alias("billing_amount_paid"),
        moment.alias("billing_date"),
        "billing_payment_status",
    )


def dim_billing(source: DataFrame) -> DataFrame:
    """Distinct billing records; a ``billing_id`` recorded in two states has two rows."""
    return _billing(source).distinct()


def billing_one_per_id(source: DataFrame) -> DataFrame:
    """The latest billing record of each ``billing_id``."""
    return one_per_key(_billing(source), ["billing_id"], newest_by=["billing_date"])


def _tuples(source: DataFrame, spec: Numbered) -> DataFrame:
    """The rows whose tuples a numbered dimension has."""
    source = _with_keys(source, spec.keys)
    return source.dropna(subset=list(spec.keys)) if spec.drop_blank else source


def dim_numbered(source: DataFrame, spec: Numbered, path: str | None = None) -> DataFrame:
    return dense_ids(_tuples(source, spec), spec.keys, spec.id_name, path)


def dims_numbered(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All numbered dimensions, from a frame for each, written by one job."""
    return dense_ids_together(
        {s.name: (_tuples(sources[s.name], s), s.keys, s.id_name) for s in NUMBERED}
    )


def dim_prescription(source: DataFrame) -> DataFrame:
    keyed = _with_keys(source, ["prescription_id"]).filter("prescription_id is not null")
    issued = keyed.withColumn(
        "prescription_duration_days", cells.parse_days(F.col("prescription_duration_days"))
    )
    return _newest(issued, t.PRESCRIPTION, ("prescription_id",)).select(*t.PRESCRIPTION)


def dim_lab_order(source: DataFrame) -> DataFrame:
    """One row per order, the latest result if it was recorded more than once."""
    ordered = (
        _with_keys(source.select(*t.LAB_ORDER), ["lab_order_id"])
        .filter("lab_order_id is not null")
        .withColumn("lab_result_date", cells.parse_timestamp(F.col("lab_result_date")))
    )
    return one_per_key(ordered, ["lab_order_id"], newest_by=["lab_result_date"])


def visit_survivors(visits: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The latest record of each visit, its time parsed.

    Records without a visit id cannot be told apart, so each of them is a visit of its own.
    """
    timed = visits.withColumn("visit_datetime", _visit_time()).select(*columns)
    own = F.when(F.col("visit_id").isNull(), F.monotonically_increasing_id())
    return one_per_key(
        timed.withColumn(_OWN, own), ["visit_id", _OWN], newest_by=["visit_datetime"]
    ).drop(_OWN)


def fact_visit(
    visits: DataFrame, dimensions: Mapping[str, DataFrame], in_order: bool = False
) -> DataFrame:
    """One row per visit with the ids of the very dimensions given.

    Duplicates go first, so that ids are looked up for one record per visit. Ties between
    records of a visit fall by the texts. ``in_order`` says that ids rise with the texts and that
    the dimensions have all the visits' tuples, as dense ids of the same rows do. Ties then fall
    alike by ids, and those that are found without a shuffle are looked up before duplicates go,
    as they are much shorter to shuffle than their texts.
    """

    def keyed(visits: DataFrame, spec: Numbered) -> DataFrame:
        visits = _with_keys(visits, spec.keys)
        if not spec.drop_blank:
            return visits
        complete = reduce(and_, (F.col(k).isNotNull() for k in spec.keys))  # half a tuple is none
        return visits.withColumns({k: F.when(complete, F.col(k)) for k in spec.keys})

    def with_id(visits: DataFrame, spec: Numbered) -> DataFrame:
        match_nulls = not spec.drop_blank
        return lookup_id(visits, dimensions[spec.name], spec.keys, spec.id_name, match_nulls)

    first = [
        spec
        for spec in NUMBERED
        if in_order and looked_up_by_broadcast(dimensions[spec.name], spec.keys, spec.id_name)
    ]
    text_of = {spec.id_name: spec.keys for spec in NUMBERED if spec not in first}
    columns = tuple(c for name in FACT_VISIT for c in text_of.get(name, (name,)))
    # A tuple is made ready just before its lookup, as code for many cells at once is too long
    # for Java to compile.
    for spec in first:  # half a tuple has no id
        visits = with_id(_with_keys(visits, spec.keys), spec)
    later = [spec for spec in NUMBERED if spec not in first]
    numbered = {spec.name for spec in NUMBERED}
    keys = [c for name, key in PRIMARY_KEYS.items() if name not in numbered for c in key]
    visits = _with_keys(reduce(keyed, later, visits), dict.fromkeys(keys))
    return reduce(with_id, later, visit_survivors(visits, columns)).select(*FACT_VISIT)


def build_model(
    source: DataFrame | Mapping[str, DataFrame],
    active_after: dt.date = cells.ACTIVE_AFTER,
    visits: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All eleven tables, from one flat table or from a frame per table.

    The numbered dimensions are written while this runs, by one job; everything else is lazy.
    The fact uses those same dimensions.
    """
    per_table = (
        source if isinstance(source, Mapping) else dict.fromkeys(PRIMARY_KEYS, source)
    )

    numbered = dims_numbered(per_table)
    built = {
        "DimPatient": dim_patient(per_table["DimPatient"], visits, active_after),
        "DimInsurance": dim_insurance(per_table["DimInsurance"]),
        "DimBilling": dim_billing(per_table["DimBilling"]),
        "DimPrescription": dim_prescription(per_table["DimPrescription"]),
        "DimLabOrder": dim_lab_order(per_table["DimLabOrder"]),
        FACT: fact_visit(per_table[FACT], numbered, in_order=True),
        **numbered,
    }
    return {name: built[name] for name in PRIMARY_KEYS}


def published(name: str, table: DataFrame) -> DataFrame:
    """The table in its written layout: moments as text cut to seconds."""
    if name not in MOMENTS:
        return table
    moment = MOMENTS[name]
    return table.withColumn(moment, cells.seconds_text(F.col(moment)))
