"""Checks over a whole model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.operators import checks
from dimloom.plans.jobs import side_by_side
from dimloom.plans.tables import FACT, LINKS, NATURAL_KEYS, PRIMARY_KEYS
from dimloom.scratch import store

TABLE_CHECKS = ("row_count", "null_rows", "duplicate_keys")
LINK_CHECKS = (
    "empty_links",
    "orphan_keys",
    "orphan_rows",
    "unused_keys",
    "rows_before",
    "rows_after",
)


def status_counts(patients: DataFrame) -> DataFrame:
    return patients.groupBy("patient_status").agg(F.count("*").alias("patients"))


def input_profile(source: DataFrame) -> DataFrame:
    """Each table's natural key in its source, before anything is removed or numbered.

    row_count, rows with a blank key part, distinct keys, and keys held by several rows. The
    source is scanned once per table for that table's key alone, so it should be landed.
    """

    def of_table(name: str, keys: Sequence[str]) -> DataFrame:
        rows = F.col("rows")
        is_empty = reduce(or_, (F.col(n).isNull() for n in checks.key_names(keys)))
        return (
            checks.key_counts(source, keys, "rows")
            .agg(
                F.coalesce(F.sum(rows), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(is_empty, rows)), F.lit(0)).alias("blank_rows"),
                F.count_if(~is_empty).alias("distinct_keys"),
                F.count_if(~is_empty & (rows > 1)).alias("repeated_keys"),
            )
            .select(F.lit(name).alias("table_name"), "*")
        )

    return checks.union_all([of_table(name, keys) for name, keys in NATURAL_KEYS.items()])


Usage = Mapping[str, DataFrame]


def model_usage(model: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """How often each primary key is held by its table and used by the fact, per table."""
    columns = {link.dimension: link.columns for link in LINKS}
    return {
        name: checks.key_usage(
            model[name], keys, model[FACT] if name in columns else None, columns.get(name, ())
        )
        for name, keys in PRIMARY_KEYS.items()
    }


def write_usage(model: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The usage counted once and stored, for all the checks that read it."""
    usage = model_usage(model)
    spark = model[FACT].sparkSession
    side_by_side(spark, *(partial(store, f"{folder}/{n}", usage[n]) for n in usage))
    return {n: spark.read.schema(k.schema).parquet(f"{folder}/{n}") for n, k in usage.items()}


STATUSES = "patient_status"


def add_usage(batch: Mapping[str, DataFrame], folder: str, name: str) -> None:
    """Count the keys of a batch of new rows, and keep the counts below the folder.

    A batch has the new rows of the fact and of any dimensions, and a name; counting a batch
    again replaces its counts. Only the batch is read.
    """
    if FACT not in batch:
        raise ValueError(f"a batch needs its rows of {FACT}, if only an empty frame")
    linked = {link.dimension: link.columns for link in LINKS}
    counted = {}
    for table, keys in PRIMARY_KEYS.items():
        fact = batch[FACT] if table in linked else None
        if table in batch:
            counted[table] = checks.key_usage(batch[table], keys, fact, linked.get(table, ()))
        else:
            none = batch[FACT].select(*keys).limit(0)
            counted[table] = checks.key_usage(none, keys, fact, keys)
    if "DimPatient" in batch:
        counted[STATUSES] = status_counts(batch["DimPatient"])
    side_by_side(
        batch[FACT].sparkSession,
        *(
            partial(store, f"{folder}/{table}/batch={name}", counts, mode="overwrite")
            for table, counts in counted.items()
        ),
    )


def kept_usage(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The usage of all batches added up per key, and the patients per status."""

    def added_up(table: str, counts: Sequence[str]) -> DataFrame:
        kept = spark.read.parquet(f"{folder}/{table}").drop("batch")
        keys = [c for c in kept.columns if c not in counts]
        return kept.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))

    usage = {table: added_up(table, ("held", "used")) for table in PRIMARY_KEYS}
    return usage, added_up(STATUSES, ("patients",))


def _links_of(usage: Usage) -> dict[str, DataFrame]:
    return {name: keys for name, keys in usage.items() if name != FACT}


def links_summary(usage: Usage) -> DataFrame:
    """One row of counts per link between the fact and a dimension."""
    profile = checks.usage_profile(_links_of(usage))
    return profile.select(F.col("label").alias("dimension"), *LINK_CHECKS)


def missing_link_keys(model: Mapping[str, DataFrame], usage: Usage) -> DataFrame:
    """(fk_column, missing_key) for every single fact column and value its dimension lacks.

    A null counts as a value. Insurance is listed by its id alone here; ``links_summary``
    tests it together with the patient.
    """
    column = {link.dimension: link.columns[:1] for link in LINKS}
    by_one = {
        name: usage[name]
        if len(PRIMARY_KEYS[name]) == 1
        else checks.key_usage(model[name], columns, model[FACT], columns)
        for name, columns in column.items()
    }
    return checks.union_all(
        [
            keys.filter((F.col("held") == 0) & (F.col("used") > 0)).select(
                F.lit(column[name][0]).alias("fk_column"),
                F.col("key_1").cast("string").alias("missing_key"),
            )
            for name, keys in by_one.items()
        ]
    )


def unused_dimension_keys(usage: Usage) -> DataFrame:
    """(dimension, unused_key, second_part) of every dimension key no visit refers to.

    ``second_part`` is null for keys of one part.
    """
    is_unused = (F.col("held") > 0) & (F.col("is_empty") | (F.col("used") == 0))
    return checks.union_all(
        [
            keys.filter(is_unused).select(
                F.lit(name).alias("dimension"),
                F.col("key_1").cast("string").alias("unused_key"),
                (F.col("key_2") if "key_2" in keys.columns else F.lit(None))
                .cast("string")
                .alias("second_part"),
            )
            for name, keys in _links_of(usage).items()
        ]
    )


def empty_links(model: Mapping[str, DataFrame]) -> DataFrame:
    """(visit_id, fk_column) of every visit without a value for one of the ten links."""
    columns = [link.columns[0] for link in LINKS]
    return checks.null_links(model[FACT], "visit_id", columns)


def report(model: Mapping[str, DataFrame], usage: Usage | None = None) -> DataFrame:
    """Every check as (check_name, table_name, column_name, value).

    ``usage`` is that of the model, if it has been counted already.
    """
    usage = model_usage(model) if usage is None else usage
    return report_of_usage(usage, status_counts(model["DimPatient"]))


def report_of_usage(usage: Usage, statuses: DataFrame) -> DataFrame:
    """The same from counts alone: the usage of keys, and the patients per status."""
    profile = checks.usage_profile(usage)
    key_of = F.create_map(
        *(F.lit(v) for name, keys in PRIMARY_KEYS.items() for v in (name, ",".join(keys)))
    )
    long = profile.unpivot("label", [*TABLE_CHECKS, *LINK_CHECKS], "check_name", "value")
    is_line = (F.col("label") != FACT) | F.col("check_name").isin(*TABLE_CHECKS)
    keys = long.filter(is_line).select(
        "check_name",
        F.col("label").alias("table_name"),
        key_of[F.col("label")].alias("column_name"),
        "value",
    )
    statuses = statuses.select(
        F.concat(F.lit("status_"), F.lower("patient_status")).alias("check_name"),
        F.lit("DimPatient").alias("table_name"),
        F.lit("patient_status").alias("column_name"),
        F.col("patients").alias("value"),
    )
    return keys.unionByName(statuses)


def torn_rows(torn: Mapping[str, DataFrame], left_out: bool = False) -> DataFrame:
    """Report lines with the number of rows of a wrong number of fields, by table or source,
    and with how many of them were left out."""
    lines = [("torn_rows", True), ("rows_left_out", left_out)]
    return checks.union_all(
        [
            broken.agg(F.count("*").alias("rows")).select(
                F.inline(
                    F.array(
                        *(
                            F.struct(
                                F.lit(check).alias("check_name"),
                                F.lit(name).alias("table_name"),
                                F.lit("*").alias("column_name"),
                                (F.col("rows") * int(counts)).alias("value"),
                            )
                            for check, counts in lines
                        )
                    )
                )
            )
            for name, broken in torn.items()
        ]
    )
