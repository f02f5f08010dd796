"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct tuples; Spark removes copies on the map side before the shuffle."""
    return df.select(*columns).distinct()


def one_per_key(
    df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the same one on every run.

    The survivor is the greatest row by ``newest_by`` and then by all other columns in their
    order, nulls lowest, so ties can only be between equal rows. Null keys form one group.

    Spark turns the ``= 1`` filter into a group limit that runs before the shuffle too. Each
    map task therefore sends at most one row per key, however many rows a hot key holds.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    order = [F.col(c).desc_nulls_last() for c in (*newest_by, *rest)]
    if not order:
        return df.distinct()
    best_first = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(best_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
