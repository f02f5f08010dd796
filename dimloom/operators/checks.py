"""Data-quality checks as DataFrames.

Counts are taken per key before anything is joined. A key held by a third of all rows is one
row in every join below, and no check ever builds the pairs of rows it reasons about.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.functions.cells import filled


def key_part(df: DataFrame, column: str) -> Column:
    """The column, null where it is blank text."""
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    return filled(F.col(column)) if is_text else F.col(column)


def _any_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(or_, (key_part(df, c).isNull() for c in columns))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def null_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table_name, key_column, null_rows) per key column, blank text counted as null."""

    def of_table(name: str) -> DataFrame:
        table = tables[name]
        counted = table.agg(
            *(F.count_if(key_part(table, k).isNull()).alias(k) for k in keys[name])
        )
        per_column = F.array(
            *(
                F.struct(F.lit(k).alias("key_column"), F.col(k).alias("null_rows"))
                for k in keys[name]
            )
        )
        return counted.select(F.lit(name).alias("table_name"), F.inline(per_column))

    return union_all([of_table(name) for name in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def missing_keys(
    fact: DataFrame, columns: Sequence[str], dimension: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Distinct key values of the fact that the dimension lacks; null counts as a value.

    Copies go first, as Spark would otherwise compare every fact row before removing them.
    """
    return fact.select(*columns).distinct().subtract(dimension.select(*keys))


def orphan_rows(
    fact: DataFrame, columns: Sequence[str], dimension: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Fact rows with a key set but not found in the dimension."""
    held = distinct_keys(dimension, keys)
    return fact.filter(~_any_missing(fact, columns)).join(held, _same(columns, keys), "left_anti")


def unused_keys(
    dimension: DataFrame, keys: Sequence[str], fact: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Dimension rows no fact row refers to."""
    used = fact.select(*(F.col(c).alias(f"_{k}") for c, k in zip(columns, keys, strict=True)))
    return dimension.join(used.distinct(), _same(keys, keys), "left_anti")


def null_links(fact: DataFrame, row_id: str, columns: Sequence[str]) -> DataFrame:
    """(row id, fk_column) for every empty foreign key, from one scan of the fact."""
    found = (F.when(key_part(fact, c).isNull(), F.lit(c)) for c in columns)
    empty = F.array_compact(F.array(*found))
    return fact.select(row_id, F.explode(empty).alias("fk_column"))


def key_counts(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows per key: columns key_1, key_2, .. of the key's own types, and the count.

    Blank parts are null; keys with such a part are rows of their own.
    """
    parts = [key_part(df, c).alias(f"key_{i}") for i, c in enumerate(columns, 1)]
    return df.select(*parts).groupBy(*key_names(columns)).agg(F.count("*").alias(name))


def key_names(columns: Sequence[str]) -> list[str]:
    return [f"key_{i}" for i, _ in enumerate(columns, 1)]


def key_usage(
    table: DataFrame,
    keys: Sequence[str],
    fact: DataFrame | None = None,
    columns: Sequence[str] = (),
) -> DataFrame:
    """How often each key is held by a table and, by the given columns, used by the fact.

    One row per key: its parts key_1, key_2, .., whether any part is missing, and the rows
    that hold and that use it. Types are kept, so a shuffled row is a short key and two counts.
    """
    names = key_names(keys)
    sides = [(table, keys, 1, 0)] + ([(fact, columns, 0, 1)] if fact is not None else [])
    rows = union_all(
        [
            df.select(
                *(key_part(df, c).alias(n) for c, n in zip(own, names, strict=True)),
                F.lit(held).alias("held"),
                F.lit(used).alias("used"),
            )
            for df, own, held, used in sides
        ]
    )
    is_empty = reduce(or_, (F.col(n).isNull() for n in names))
    return (
        rows.groupBy(*names)
        .agg(F.sum("held").alias("held"), F.sum("used").alias("used"))
        .select(*names, is_empty.alias("is_empty"), "held", "used")
    )


def usage_profile(usage: Mapping[str, DataFrame]) -> DataFrame:
    """Numbers on each label's key and on the fact's link to it.

    row_count       rows of the table
    null_rows       its rows with any key part missing
    duplicate_keys  keys held by two rows or more
    empty_links     fact rows whose link has a missing part
    orphan_keys     distinct values set in the fact but absent from the table
    orphan_rows     fact rows that carry them
    unused_keys     keys of the table no fact row refers to
    rows_before     fact rows
    rows_after      rows a left join of the fact and the table would give
    """
    held, used, is_empty = F.col("held"), F.col("used"), F.col("is_empty")
    is_orphan = ~is_empty & (held == 0)

    def total(rows: Column, name: str) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0)).alias(name)

    return union_all(
        [
            keys.agg(
                total(held, "row_count"),
                total(F.when(is_empty, held), "null_rows"),
                F.count_if(held > 1).alias("duplicate_keys"),
                total(F.when(is_empty, used), "empty_links"),
                F.count_if(is_orphan).alias("orphan_keys"),
                total(F.when(is_orphan, used), "orphan_rows"),
                F.count_if((held > 0) & (is_empty | (used == 0))).alias("unused_keys"),
                total(used, "rows_before"),
                total(used * F.when(is_empty | (held == 0), 1).otherwise(held), "rows_after"),
            ).select(F.lit(label).alias("label"), "*")
            for label, keys in usage.items()
        ]
    )


def distinct_keys(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension's key values, prefixed so that they can be joined to equal names."""
    return dimension.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()


def _same(columns: Sequence[str], keys: Sequence[str]) -> Column:
    return reduce(
        and_, (F.col(c) == F.col(f"_{k}") for c, k in zip(columns, keys, strict=True))
    )
