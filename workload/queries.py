"""Every query, by name: (spark, folder of test tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.functions import cells
from dimloom.operators import checks
from dimloom.operators.dedup import distinct_rows, one_per_key
from dimloom.operators.keys import dense_ids, extended_ids
from dimloom.plans import model as m
from dimloom.plans import quality, reports, run
from dimloom.plans import tables as t
from dimloom.scratch import scratch_path, store
from dimloom.settings import MB
from dimloom.sources.flat import BROKEN, cell_rejects, land_flat, read_flat
from dimloom.sources.tables import read_csv_table, write_csv
from workload import roles

Query = Callable[[SparkSession, str], DataFrame]

# The test orders end in August 2001.
ACTIVE_AFTER = dt.date(2001, 6, 30)
RERUN_FROM = dt.datetime(1996, 1, 1)

# The flat table as text repeats every subject's texts in each visit; packed, it is a tenth. The
# model's tables are a quarter.
TEXT_CODEC = "gzip"

# Set by a caller whose tables come in fewer pieces than its cores can use.
PARTITIONS_SETTING = "spark.dimloom.input.partitions"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"

# The tables are packed; as text, with a visit's subjects in its row, they are several times as much.
INPUT_PER_SHUFFLE_PARTITION = 8 * MB

_written: dict[tuple, dict[str, DataFrame]] = {}


def open_tables(spark: SparkSession, sf_dir: str) -> roles.Tables:
    # The tables hold zone-free times, which pass through text here. No zone shift is wanted.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A task's share of a shuffle must not grow with the tables, or its sorts spill.
    wanted = input_bytes(spark, sf_dir) // INPUT_PER_SHUFFLE_PARTITION
    if wanted > int(spark.conf.get(SHUFFLE_PARTITIONS)):
        spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))
    return roles.Tables(spark, sf_dir, int(spark.conf.get(PARTITIONS_SETTING, "0")))


def build(tables: roles.Tables) -> dict[str, DataFrame]:
    return m.build_model(roles.sources(tables), ACTIVE_AFTER, visits=roles.orders(tables))


def _folder(spark: SparkSession, sf_dir: str):
    """The folder's file system and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def newest_file(spark: SparkSession, sf_dir: str) -> int:
    """When the folder's files last changed."""
    system, path = _folder(spark, sf_dir)
    return max(file.getModificationTime() for file in system.listStatus(path))


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """The size of the tables the model is built from."""
    system, path = _folder(spark, sf_dir)
    return sum(
        system.getContentSummary(file.getPath()).getLength()
        for file in system.listStatus(path)
        if file.getPath().getName().removesuffix(".parquet") in roles.TABLES
    )


def _once(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Stored tables, written below a fresh folder once per session and state of the input."""
    key = (spark.sparkContext.applicationId, sf_dir, newest_file(spark, sf_dir), label)
    if key not in _written:
        _written[key] = write(scratch_path(spark, label))
    return _written[key]


def written_model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The model as stored tables."""
    tables = open_tables(spark, sf_dir)
    return _once(spark, sf_dir, "model", lambda path: run.write_model(build(tables), path))


def written(
    spark: SparkSession, sf_dir: str
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The model, and the usage of its keys for those who ask for it, as stored tables."""
    model = written_model(spark, sf_dir)
    return model, _once(spark, sf_dir, "usage", lambda path: quality.write_usage(model, path))


def on_model(query: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(written_model(spark, sf_dir))


def on_usage(query: Callable[..., DataFrame]) -> Query:
    """A query on the model and the usage of its keys."""
    return lambda spark, sf_dir: query(*written(spark, sf_dir))


def on_tables(query: Callable[[roles.Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(open_tables(spark, sf_dir))


def dim_patient_status(tables: roles.Tables) -> DataFrame:
    return m.dim_patient(roles.customers(tables), roles.orders(tables), ACTIVE_AFTER)


def from_flat(
    builder: Callable[[DataFrame], DataFrame], name: str, tables: roles.Tables
) -> DataFrame:
    """A table built from the one flat frame, in its published layout."""
    return m.published(name, builder(roles.flat(tables)))


def from_mixed_times(
    builder: Callable[[DataFrame], DataFrame], name: str, tables: roles.Tables
) -> DataFrame:
    return m.published(name, builder(roles.mixed_times(tables)))


def fact_from_flat(flat: DataFrame) -> DataFrame:
    """The fact and the dimensions it looks up, from the flat frame stored once for them all."""
    numbered = {c for spec in t.NUMBERED for c in spec.keys}
    used = [c for c in flat.columns if c in numbered or c in t.FACT_VISIT]
    flat = landed(flat.select(*used))
    dimensions = m.dims_numbered(dict.fromkeys(t.PRIMARY_KEYS, flat))
    return m.fact_visit(flat, dimensions, in_order=True)


def numbered(spec: t.Numbered, tables: roles.Tables) -> DataFrame:
    return m.dim_numbered(roles.SOURCES[spec.name](tables), spec)


def fact_visit(tables: roles.Tables) -> DataFrame:
    return m.published(t.FACT, build(tables)[t.FACT])


def visit_survivor(tables: roles.Tables) -> DataFrame:
    lines = tables.dealt("lineitem")
    return one_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def part_supplier_ids(tables: roles.Tables) -> DataFrame:
    """Dense ids for a key that grows with the data."""
    return dense_ids(tables["lineitem"], ["l_partkey", "l_suppkey"], "pair_id")


def pair_ids_after_append(tables: roles.Tables) -> DataFrame:
    """Ids given to the pairs of some lines stay when all lines are there."""
    keys, lines = ["l_partkey", "l_suppkey"], tables["lineitem"]
    first = dense_ids(lines.where("l_orderkey % 2 = 0"), keys, "pair_id")
    return extended_ids(first, lines, keys, "pair_id")


def distinct_pairs(tables: roles.Tables) -> DataFrame:
    return distinct_rows(tables["lineitem"], ["l_partkey", "l_suppkey"])


def landed_keys(flat: DataFrame) -> DataFrame:
    """All rows with the columns their key profile reads, so that no other is joined or stored."""
    return landed(flat.select(*dict.fromkeys(c for keys in t.NATURAL_KEYS.values() for c in keys)))


def landed(frame: DataFrame) -> DataFrame:
    path = scratch_path(frame.sparkSession, "landed")
    store(path, frame)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def blank_keys_model(tables: roles.Tables) -> dict[str, DataFrame]:
    return m.build_model(landed(roles.blank_keys(tables)), ACTIVE_AFTER)


def blank_keys_report(tables: roles.Tables) -> DataFrame:
    """The report on the stored model: its checks read the fact ten times and build it once."""
    model = run.write_model(blank_keys_model(tables), scratch_path(tables.spark, "model"))
    return quality.report(model)


def torn_rows(tables: roles.Tables) -> DataFrame:
    """What is read of text with torn rows; all of them stay among the rows."""
    read = read_flat(tables.spark, text_files(roles.torn_lines(tables)))
    rows, _ = land_flat(read.withColumn("is_torn", F.col(BROKEN).isNotNull()))
    return rows.select(*TORN_COLUMNS, "is_torn")


TORN_COLUMNS = ("patient_id", "patient_first_name", "patient_last_name", "visit_id")


def text_files(lines: DataFrame) -> str:
    """Lines (file, is_header, value) as text files; their paths as a pattern."""
    path = scratch_path(lines.sparkSession, "text")
    (
        lines.repartition("file")
        .sortWithinPartitions("file", F.desc("is_header"))
        .select("file", "value")
        .write.partitionBy("file")
        .text(path)
    )
    return f"{path}/file=*"


def line_breaks(tables: roles.Tables) -> DataFrame:
    """What is read of text with line breaks in quoted fields; rows with a field too many stay."""
    path = text_files(roles.quoted_lines(tables, ","))
    read = read_flat(tables.spark, path, multiline=True)
    rows, _ = land_flat(read.withColumn("is_torn", F.col(BROKEN).isNotNull()))
    return rows.select(*TORN_COLUMNS, "is_torn")


def line_breaks_left_out(tables: roles.Tables) -> DataFrame:
    """The same with another separator, torn rows left out, and how many lines those have."""
    path = text_files(roles.quoted_lines(tables, ";"))
    rows, broken = land_flat(read_flat(tables.spark, path, ";", multiline=True), keep_broken=False)
    lines_of = F.size(F.split(BROKEN, "\n"))
    left_out = broken.agg(F.coalesce(F.sum(lines_of), F.lit(0)).cast("string").alias("visit_id"))
    absent = [F.lit(None).cast("string").alias(c) for c in TORN_COLUMNS[:-1]]
    return rows.select(*TORN_COLUMNS).unionByName(left_out.select(*absent, "visit_id"))


def mixed_rejects(tables: roles.Tables) -> DataFrame:
    """Times of every precision can be read."""
    rejected = cell_rejects(roles.mixed_times(tables))
    dates = rejected.where("column_name in ('visit_datetime', 'billing_date')")
    return dates.agg(F.count("*").cast("int").alias("rejects"))


def csv_round_trip(tables: roles.Tables) -> DataFrame:
    path = scratch_path(tables.spark, "flat-csv")
    write_csv(roles.flat(tables), path, compression=TEXT_CODEC)
    return read_flat(tables.spark, path).drop("_broken_row")


def normalized_counts(tables: roles.Tables) -> DataFrame:
    """Row counts after a whole run that starts from the flat table as text."""
    text = scratch_path(tables.spark, "flat-csv")
    write_csv(roles.flat(tables), text, compression=TEXT_CODEC)
    model = run.normalize(
        tables.spark,
        text,
        scratch_path(tables.spark, "run"),
        active_after=ACTIVE_AFTER,
        compression=TEXT_CODEC,
    )
    return checks.row_counts(model)


def quality_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from counts kept per batch: the model in two halves, one counted twice."""
    folder = scratch_path(spark, "kept")
    for half in (0, 1, 1):
        batch = {
            name: table.where(F.pmod(F.xxhash64(*t.PRIMARY_KEYS[name]), F.lit(2)) == half)
            for name, table in written_model(spark, sf_dir).items()
        }
        quality.add_usage(batch, folder, str(half))
    return quality.report_of_usage(*quality.kept_usage(spark, folder))


def exported_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on the model's tables written as text and read back."""
    folder = scratch_path(spark, "csv")
    run.export_model(written_model(spark, sf_dir), folder, compression=TEXT_CODEC)
    return run.validate_export(spark, folder)


def fact_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written as text by month, and read back month by month."""
    folder = scratch_path(spark, "csv")
    run.export_model(written_model(spark, sf_dir), folder, fact_by_month=True, compression=TEXT_CODEC)
    return months_of(read_csv_table(spark, f"{folder}/{t.FACT}", t.COLUMNS[t.FACT]))


def months_of(fact: DataFrame) -> DataFrame:
    return fact.groupBy("visit_month", "visit_type").agg(
        F.count("*").alias("visits"),
        F.min("visit_datetime").alias("first_visit"),
        F.max("visit_datetime").alias("last_visit"),
    )


def fact_months_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over the later visits replaces their months and leaves the others."""
    folder = scratch_path(spark, "csv")
    fact = written_model(spark, sf_dir)[t.FACT]
    first = fact.withColumn("visit_type", F.lit("first run"))
    run.export_fact_by_month(first, folder, keep_other_months=True)
    later = fact.where(F.col("visit_datetime") >= RERUN_FROM)
    run.export_fact_by_month(later, folder, keep_other_months=True)
    return months_of(read_csv_table(spark, folder, t.COLUMNS[t.FACT]))


def exported_quality_torn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a file of torn rows beside a dimension's own."""
    folder = scratch_path(spark, "csv")
    run.export_model(written_model(spark, sf_dir), folder, compression=TEXT_CODEC)
    lines = [",".join(t.COLUMNS["DimLocation"]), "7777777,Torn", "7777778,Torn,Room,one more"]
    text = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    text.write.mode("append").text(f"{folder}/DimLocation")
    return run.validate_export(spark, folder)


def parsed_cells(tables: roles.Tables) -> DataFrame:
    visit = cells.parse_timestamp(F.col("visit_datetime"), cells.MICROSECOND_PATTERN)
    either = cells.parse_timestamp(
        F.col("visit_datetime"), cells.MICROSECOND_PATTERN, cells.SECOND_PATTERN
    )
    lab = cells.parse_timestamp(F.col("lab_result_date"))
    return roles.messy(tables).select(
        "visit_id",
        visit.alias("visit_ts"),
        visit.cast("date").alias("visit_date"),
        either.alias("lenient_ts"),
        lab.alias("lab_ts"),
        cells.seconds_text(lab).alias("lab_text"),
        cells.parse_amount(F.col("billing_total_charge")).alias("charge"),
        cells.parse_amount(F.col("billing_amount_paid")).alias("paid"),
        cells.parse_days(F.col("prescription_duration_days")).alias("days"),
    )


def reject_counts(tables: roles.Tables) -> DataFrame:
    return (
        cell_rejects(roles.messy(tables))
        .groupBy("column_name", "reason")
        .agg(F.count("*").alias("rejects"))
    )


def billing_conflicts(tables: roles.Tables) -> DataFrame:
    """Billing ids recorded in more than one state, with their number of states."""
    return checks.duplicate_keys(m.dim_billing(roles.line_billing(tables)), ["billing_id"])


def repeated_lines(tables: roles.Tables) -> DataFrame:
    return checks.duplicate_keys(tables["lineitem"], ["l_orderkey", "l_linenumber"])


def lab_orphans(model: dict[str, DataFrame]) -> DataFrame:
    key = ["lab_order_id"]
    return checks.orphan_rows(model[t.FACT], key, model["DimLabOrder"], key).select(
        "visit_id", "lab_order_id"
    )


def insurance_fan_out(model: dict[str, DataFrame]) -> DataFrame:
    """What a join on the insurance id alone would do, against the id with the patient."""

    insurance, fact = model["DimInsurance"], model[t.FACT]
    keys = {",".join(k): k for k in (("insurance_id",), ("insurance_id", "patient_id"))}
    usage = {name: checks.key_usage(insurance, k, fact, k) for name, k in keys.items()}
    return checks.usage_profile(usage).select(
        F.col("label").alias("join_columns"), "rows_before", "rows_after"
    )


def missing_lab_orders(model: dict[str, DataFrame]) -> DataFrame:
    key = ["lab_order_id"]
    return checks.missing_keys(model[t.FACT], key, model["DimLabOrder"], key)


def unused_billings(model: dict[str, DataFrame]) -> DataFrame:
    key = ["billing_id"]
    return checks.unused_keys(model["DimBilling"], key, model[t.FACT], key).select(
        "billing_id", "billing_payment_status"
    )


def fan_out(_: dict[str, DataFrame], usage: dict[str, DataFrame]) -> DataFrame:
    return quality.links_summary(usage).select("dimension", "rows_before", "rows_after")


def gender_table(model: dict[str, DataFrame]) -> DataFrame:
    # Two customer segments of the test tables, in the place of genders.
    segments = ["AUTOMOBILE", "BUILDING"]
    return reports.gender_columns(reports.visits_by_provider_and_gender(model), segments)


NUMBERED_QUERIES = dict(
    zip(
        (
            "dim_provider",
            "dim_location",
            "dim_primary_diagnosis",
            "dim_secondary_diagnosis",
            "dim_treatment",
        ),
        t.NUMBERED,
        strict=True,
    )
)

QUERIES: dict[str, Query] = {
    # dimensions and the fact
    "dim_patient_status": on_tables(dim_patient_status),
    "dim_insurance": on_tables(lambda x: m.dim_insurance(roles.orders(x))),
    "dim_billing": on_tables(
        lambda x: m.published("DimBilling", m.dim_billing(roles.orders(x)))
    ),
    "dim_billing_lines": on_tables(
        lambda x: m.published("DimBilling", m.dim_billing(roles.line_billing(x)))
    ),
    "billing_one_per_id": on_tables(
        lambda x: m.published("DimBilling", m.billing_one_per_id(roles.line_billing(x)))
    ),
    **{
        query: on_tables(partial(numbered, spec)) for query, spec in NUMBERED_QUERIES.items()
    },
    "dim_prescription": on_tables(lambda x: m.dim_prescription(roles.parts(x))),
    "dim_lab_order": on_tables(
        lambda x: m.published("DimLabOrder", m.dim_lab_order(roles.events(x)))
    ),
    "fact_visit": on_tables(fact_visit),
    # the same tables from the flat frame
    **{
        f"{query}_from_flat": on_tables(partial(from_flat, builder, name))
        for query, name, builder in (
            ("dim_patient", "DimPatient", partial(m.dim_patient, active_after=ACTIVE_AFTER)),
            ("dim_insurance", "DimInsurance", m.dim_insurance),
            ("dim_billing", "DimBilling", m.dim_billing),
            *(
                (query, spec.name, partial(m.dim_numbered, spec=spec))
                for query, spec in NUMBERED_QUERIES.items()
            ),
            ("dim_prescription", "DimPrescription", m.dim_prescription),
            ("dim_lab_order", "DimLabOrder", m.dim_lab_order),
            ("fact_visit", t.FACT, fact_from_flat),
        )
    },
    # the same from times of several precisions and from blank keys
    **{
        f"{query}_mixed_times": on_tables(partial(from_mixed_times, builder, name))
        for query, name, builder in (
            ("dim_patient", "DimPatient", partial(m.dim_patient, active_after=ACTIVE_AFTER)),
            ("dim_billing", "DimBilling", m.dim_billing),
            ("fact_visit", t.FACT, fact_from_flat),
        )
    },
    "blank_keys_fact": on_tables(
        lambda x: m.published(t.FACT, fact_from_flat(roles.blank_keys(x)))
    ),
    "parse_rejects_mixed_times": on_tables(mixed_rejects),
    # single operators
    "visit_survivor": on_tables(visit_survivor),
    "distinct_pairs": on_tables(distinct_pairs),
    "part_supplier_ids": on_tables(part_supplier_ids),
    "pair_ids_after_append": on_tables(pair_ids_after_append),
    "last_visits": on_tables(lambda x: m.last_visits(roles.orders(x))),
    "parsed_cells": on_tables(parsed_cells),
    "parse_rejects": on_tables(reject_counts),
    "cell_rejects": on_tables(lambda x: cell_rejects(roles.messy(x))),
    "csv_round_trip": on_tables(csv_round_trip),
    "torn_rows": on_tables(torn_rows),
    "line_breaks": on_tables(line_breaks),
    "line_breaks_left_out": on_tables(line_breaks_left_out),
    "normalized_counts": on_tables(normalized_counts),
    # quality checks
    "input_key_profile": on_tables(lambda x: quality.input_profile(landed_keys(roles.flat(x)))),
    "model_row_counts": on_model(checks.row_counts),
    "patient_status_counts": on_model(lambda x: quality.status_counts(x["DimPatient"])),
    "pk_null_counts": on_model(lambda x: checks.null_keys(x, t.PRIMARY_KEYS)),
    "billing_conflicts": on_tables(billing_conflicts),
    "pk_duplicates": on_tables(repeated_lines),
    "fk_missing_keys": on_usage(quality.missing_link_keys),
    "lab_missing_keys": on_model(missing_lab_orders),
    "fk_orphan_rows": on_model(lab_orphans),
    "fk_null_rows": on_model(quality.empty_links),
    "fk_summary": on_usage(lambda _, usage: quality.links_summary(usage)),
    "dim_unused_keys": on_usage(lambda _, usage: quality.unused_dimension_keys(usage)),
    "billing_unused_rows": on_model(unused_billings),
    "fanout_check": on_usage(fan_out),
    "insurance_fan_out": on_model(insurance_fan_out),
    "quality_report": on_usage(quality.report),
    "quality_in_batches": quality_in_batches,
    "fact_by_month": fact_by_month,
    "fact_months_rerun": fact_months_rerun,
    "exported_quality": exported_quality,
    "exported_quality_torn": exported_quality_torn,
    "blank_keys_profile": on_tables(
        lambda x: quality.input_profile(landed_keys(roles.blank_keys(x)))
    ),
    "blank_keys_pk_nulls": on_tables(
        lambda x: checks.null_keys(blank_keys_model(x), t.PRIMARY_KEYS)
    ),
    "blank_keys_fk_nulls": on_tables(
        lambda x: quality.empty_links({t.FACT: fact_from_flat(roles.blank_keys(x))})
    ),
    "blank_keys_report": on_tables(blank_keys_report),
    # reports
    "monthly_visits": on_model(lambda x: reports.monthly_visits(x[t.FACT])),
    "visits_by_location_type": on_model(reports.visits_by_clinic_and_type),
    "visits_by_department_gender": on_model(reports.visits_by_provider_and_gender),
    "visits_by_segment_brand": on_model(
        lambda x: reports.visits_by_provider_and_gender(x, "doctor_name")
    ),
    "gender_columns": on_model(gender_table),
    "billing_running_total": on_model(lambda x: reports.billing_by_month(x["DimBilling"])),
    "billing_running_total_conflicts": on_tables(
        lambda x: reports.billing_by_month(m.dim_billing(roles.line_billing(x)))
    ),
    "provider_activity": on_model(reports.visits_by_doctor),
}
