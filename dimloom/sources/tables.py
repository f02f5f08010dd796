"""Reading and writing the model's tables as directories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from dimloom.plans.tables import PRIMARY_KEYS
from dimloom.scratch import shuffles_freed, store
from dimloom.sources.flat import CSV_OPTIONS, read_text


def spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each partition value's rows in few files; a large value keeps several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    store(path, spread(df, partition_by), "overwrite", partition_by)


# A packed file is read by one task from its start, so it is kept this short.
ROWS_PER_PACKED_FILE = 1_000_000


def write_csv(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replace_all: bool = True,
    compression: str = "none",
    gathered: bool = False,
) -> None:
    """Text with a header in every part file, written by all tasks in parallel.

    ``gathered`` says that each partition value's rows are in few tasks already. Without ``replace_all``, partitions that the frame has no rows of stay as they are. With a
    ``compression`` Spark knows, such as gzip, the files are packed, and read like any others.
    """
    rows_per_file = 0 if compression == "none" else ROWS_PER_PACKED_FILE
    rows = df if gathered else spread(df, partition_by)
    with shuffles_freed(df.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
            .partitionBy(*partition_by)
            .options(**CSV_OPTIONS, compression=compression, maxRecordsPerFile=rows_per_file)
            .csv(path)
        )


def read_csv_table(
    spark: SparkSession, path: str, columns: Sequence[str], multiline: bool = False
) -> DataFrame:
    """A written table as text, and the raw line of rows with too few or too many fields.

    Its header must carry exactly these columns.
    """
    return read_text(spark, path, columns, multiline=multiline)


def read_model(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """All tables of a model written as Parquet below one folder."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in PRIMARY_KEYS}
