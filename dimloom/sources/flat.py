"""The flat input: delimited text with a header, one row per visit record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.functions import cells
from dimloom.plans import tables as t
from dimloom.scratch import scratch_path, store
from dimloom.sources.records import read_records

FLAT_COLUMNS = (
    *t.PATIENT,
    *t.VISIT,
    *t.INSURANCE,
    *t.BILLING,
    *t.PROVIDER,
    *t.LOCATION,
    *t.PRIMARY_DIAGNOSIS,
    *t.SECONDARY_DIAGNOSIS,
    *t.TREATMENT,
    *t.PRESCRIPTION,
    *t.LAB_ORDER,
)
BROKEN = "_broken_row"

# Written and read alike, so that quotes, separators, line breaks and outer blanks survive.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_flat(
    spark: SparkSession, path: str, separator: str = ",", multiline: bool = False
) -> DataFrame:
    """All columns as text under their header names, plus the raw line of rows that do not fit.

    Columns may come in any order and any case; files whose headers disagree fail instead of
    being read shifted. Line breaks inside fields need ``multiline``: the lines are then dealt by
    their split once, to be cut into records. The default saves that, and shows such rows as broken.
    """
    options = {**CSV_OPTIONS, "sep": separator, "multiLine": multiline}
    header = spark.read.options(**options).csv(path).columns
    # Names that differ in case only are numbered by Spark, and so count as missing.
    by_name = {column.lower(): column for column in header}
    missing = [c for c in FLAT_COLUMNS if c not in by_name]
    if missing:
        raise ValueError(f"flat input lacks columns {missing}")
    text = read_text(spark, path, header, separator, multiline)
    return text.select(*(F.col(f"`{by_name[c]}`").alias(c) for c in FLAT_COLUMNS), BROKEN)


def read_text(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    separator: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with these columns in its header, all as text, and the raw text of rows with
    too few or too many fields. Another header in any file is an error."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, BROKEN)])
    options = {**CSV_OPTIONS, "sep": separator, "multiLine": multiline}
    # Fields of a row are only counted if all columns are parsed, wanted or not.
    options |= {"columnNameOfCorruptRecord": BROKEN, "columnPruning": False, "mode": "PERMISSIVE"}
    if not multiline:
        return spark.read.options(**options, enforceSchema=False).schema(schema).csv(path)
    told = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    fields = ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names)
    row = F.from_csv("record", fields, told | {"header": "false"})
    parsed = read_records(spark, path, separator).select("is_first", row.alias("row"))
    names = F.array(*(F.lower(F.col("row")[c]) for c in columns))
    wanted = F.array(*(F.lit(c.lower()) for c in columns))
    is_header = F.col(f"row.{BROKEN}").isNull() & names.eqNullSafe(wanted)
    wrong = F.raise_error(F.concat(F.lit("unexpected header: "), F.array_join(names, separator)))
    is_row = F.when(~F.col("is_first"), True).when(is_header, False)
    is_row = is_row.otherwise(wrong.cast("boolean"))
    return parsed.where(is_row).select("row.*")


def land_flat(
    flat: DataFrame,
    path: str | None = None,
    keep_broken: bool = True,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write the text once as Parquet; return its rows and the raw lines of broken ones.

    Every table is then built from a column-pruned scan instead of parsing the text again.
    Rows with too few or too many fields stay among the rows with the cells that were read,
    and are reported. As such cells may be shifted, a caller may choose to leave these rows
    out with ``keep_broken=False``. ``partitions`` deals text out that arrives in too few
    splits for the cluster, such as a few packed files.
    """
    spark = flat.sparkSession
    path = path or scratch_path(spark, "flat")
    if partitions:
        flat = flat.repartition(partitions)
    store(path, flat, mode="overwrite")
    landed = spark.read.schema(flat.schema).parquet(path)
    is_broken = F.col(BROKEN).isNotNull()
    rows = landed if keep_broken else landed.filter(~is_broken)
    return rows.drop(BROKEN), landed.filter(is_broken).select(BROKEN)


def cell_rejects(flat: DataFrame) -> DataFrame:
    """One row per cell that holds text its column's parser cannot read.

    The row itself stays in the model with a null in that place; nothing is dropped here.
    """
    parsers = {
        "visit_datetime": (
            "not a timestamp",
            lambda c: cells.parse_timestamp(c, *cells.MOMENT_PATTERNS),
        ),
        "billing_date": (
            "not a timestamp",
            lambda c: cells.parse_timestamp(c, *cells.MOMENT_PATTERNS),
        ),
        "lab_result_date": ("not a timestamp", cells.parse_timestamp),
        "billing_total_charge": ("not an amount", cells.parse_amount),
        "billing_amount_paid": ("not an amount", cells.parse_amount),
        "prescription_duration_days": ("not a whole number", cells.parse_days),
    }
    present = {c: p for c, p in parsers.items() if c in flat.columns}
    found = [
        F.when(
            cells.unreadable(F.col(c), parse(F.col(c))),
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("raw_value"),
                F.lit(reason).alias("reason"),
            ),
        )
        for c, (reason, parse) in present.items()
    ]
    return (
        flat.select("visit_id", F.explode(F.array_compact(F.array(*found))).alias("cell"))
        .select("visit_id", "cell.*")
    )
