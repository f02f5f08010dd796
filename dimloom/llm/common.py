"""What the operators share: reading a table, stored intermediate tables, numbered tasks."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import dimloom
from dimloom.scratch import scratch_path

# Rows and bytes handed to Python at once. Texts of a batch are in memory together.
BATCH_ROWS = 400
BATCH_BYTES = 16 << 20
BROADCAST_BYTES = 32 << 20
HOT_SHARE = 1000


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may run anywhere, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(dimloom.__file__).parent
        archive = f"{tempfile.mkdtemp(prefix='dimloom-package-')}/dimloom"
        context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def in_small_batches(step: Callable) -> Callable:
    """The step over Arrow batches, given a bounded number of rows and bytes at once.

    Spark's own batches are as large as the session says; the operators leave that setting alone.
    """

    def over_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return step(slices(batches))

    return over_slices


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        parts = max(-(-rows // BATCH_ROWS), min(rows, -(-batch.nbytes // BATCH_BYTES)), 1)
        size = max(1, -(-rows // parts))
        for at in range(0, max(rows, 1), size):
            yield batch.slice(at, size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, for a registered query: it has the session to itself, so Spark's
    own batches for Python are kept small enough for very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back.

    Cuts the plan: later passes see the same rows even if an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, bytes_a_row: int) -> bool:
    """Whether a stored frame may be broadcast, by its rows and their size in memory."""
    return df.count() * bytes_a_row <= BROADCAST_BYTES


def join_hot(
    rows: DataFrame, table: DataFrame, keys: list[str], held: Column, total: int, how: str
) -> DataFrame:
    """Joins rows to a stored table with one row a key, by broadcast if that is small.

    Otherwise keys that hold more than a thousandth of the ``total`` rows, by the column ``held`` of
    the table, are fewer than a thousand; they are joined by broadcast, so their rows stay where
    they are, and only the others are shuffled.
    """
    if small_enough(table, 64 + 32 * len(table.columns)):
        return rows.join(F.broadcast(table), keys, how)
    hot = held * HOT_SHARE > total
    marks = F.broadcast(table.where(hot).select(*keys, F.lit(True).alias("_hot")))
    marked = rows.join(marks, keys, "left")
    often = marked.where("_hot").drop("_hot")
    seldom = marked.where("_hot is null").drop("_hot")
    return often.join(F.broadcast(table.where(hot)), keys, how).unionByName(
        seldom.join(table.where(~hot), keys, how)
    )


def whole(text: str) -> Column:
    """The text column, null taken as empty."""
    return F.coalesce(F.col(text), F.lit(""))
