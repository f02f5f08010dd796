"""Dense surrogate ids and their lookup."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.scratch import make_folder, scratch_path, store

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def number_rows(
    df: DataFrame, order: Sequence[str | Column], number: str, path: str | None = None
) -> DataFrame:
    """All rows with their position 0, 1, .. in the given order, without a global window.

    The rows are range-sorted in parallel and written once, each with its range and its row in
    that range. One count per range, a frame no longer than the number of shuffle partitions,
    gives each range's offset, which a broadcast join adds. Nothing reaches the driver.

    The table is written rather than cached: both passes must see the same ranges, a lost
    executor must not change them, and readers get its exact size for choosing a join.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, number)
    sorted_rows = df.orderBy(*order).withColumn("_position", F.monotonically_increasing_id())
    store(path, sorted_rows)

    written = _with_ranges(spark.read.schema(sorted_rows.schema).parquet(path))
    return written.join(F.broadcast(_offsets(written)), "_range").select(
        (F.col("_offset") + F.col("_row")).alias(number), *df.columns
    )


def _with_ranges(written: DataFrame) -> DataFrame:
    return written.withColumns(
        {
            "_range": F.shiftright("_position", _ROW_BITS),
            "_row": F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )


def _offsets(written: DataFrame) -> DataFrame:
    """One row a range: its first row, and how many rows the ranges before it have."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        written.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
        .select(
            "_range", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
        )
    )


def dense_ids(
    df: DataFrame, keys: Sequence[str], id_name: str, path: str | None = None
) -> DataFrame:
    """Distinct key tuples numbered 1..n in the order of all key columns, nulls first.

    Equal to a ``row_number`` over one global window, without its single task. Tuples are
    distinct before they are sorted, so ranges are even whatever the key frequencies are,
    and the ids depend neither on the ranges nor on the partition count.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    numbered = number_rows(df.select(*keys).distinct(), order, id_name, path)
    return numbered.select((F.col(id_name) + 1).alias(id_name), *keys)


def dense_ids_together(
    sources: Mapping[str, tuple[DataFrame, Sequence[str], str]], path: str | None = None
) -> dict[str, DataFrame]:
    """``dense_ids`` of several frames of text keys, given as (frame, keys, id name), in one job.

    The tuples of all frames are sorted together, by frame first, and written once, a directory
    for each frame. Its positions then start in the ranges it begins in, so one count and one
    first row per range and frame make the ids; the fixed cost of a sort is paid once.
    """
    spark = next(iter(sources.values()))[0].sparkSession
    path = path or scratch_path(spark, "numbered")
    width = max(len(keys) for _, keys, _ in sources.values())
    parts = [f"_part{i}" for i in range(width)]
    tuples = [
        df.select(
            F.lit(nth).alias("_frame"),
            *(F.col(k).alias(part) for k, part in zip(keys, parts, strict=False)),
            *(F.lit(None).cast("string").alias(part) for part in parts[len(keys) :]),
        )
        for nth, (df, keys, _) in enumerate(sources.values())
    ]
    order = ["_frame", *(F.col(part).asc_nulls_first() for part in parts)]
    sorted_rows = (
        reduce(DataFrame.unionByName, tuples)
        .distinct()
        .orderBy(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    store(path, sorted_rows, by=["_frame"])
    schema = sorted_rows.drop("_frame").schema

    def numbered(nth: int, keys: Sequence[str], id_name: str) -> DataFrame:
        # Read by its own folder, so that Spark knows the size of this frame alone.
        own = f"{path}/_frame={nth}"
        make_folder(spark, own)  # there is none for a frame without rows
        rows = _with_ranges(spark.read.schema(schema).parquet(own))
        # Its rows of a range are in one run, after those of the frames before it.
        number = F.col("_offset") + F.col("_row") - F.col("_first") + 1
        return rows.join(F.broadcast(_offsets(rows)), "_range").select(
            number.alias(id_name), *(F.col(p).alias(k) for p, k in zip(parts, keys, strict=False))
        )

    return {
        name: numbered(nth, keys, id_name)
        for nth, (name, (_, keys, id_name)) in enumerate(sources.items())
    }


def extended_ids(
    kept: DataFrame, df: DataFrame, keys: Sequence[str], id_name: str, path: str | None = None
) -> DataFrame:
    """The ids of a kept key map (id, keys) as they are, and ids for the tuples it lacks.

    New tuples are numbered after the greatest kept id, in the order of the keys, nulls first.
    The map is as long as the dimension, so a run over more rows changes no id given before.
    """
    known = kept.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    new = df.select(*keys).distinct().join(known, same, "left_anti")
    after = kept.agg(F.max(id_name)).first()[0] or 0
    added = dense_ids(new, keys, id_name, path)
    return kept.select(id_name, *keys).unionByName(
        added.select((F.col(id_name) + after).alias(id_name), *keys)
    )


def _right_side(
    dimension: DataFrame, keys: Sequence[str], id_name: str, hashed: Callable[..., Column]
) -> DataFrame:
    parts = (F.col(k).alias(f"_{k}") for k in keys)
    return dimension.select(id_name, *parts, hashed(*keys).alias("_hash"))


def looked_up_by_broadcast(dimension: DataFrame, keys: Sequence[str], id_name: str) -> bool:
    """If ``lookup_id`` shuffles nothing: by what Spark knows of its size, it broadcasts the dimension."""
    right = _right_side(dimension, keys, id_name, F.xxhash64)
    size = right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    most = dimension.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= most


def lookup_id(
    df: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    id_name: str,
    match_nulls: bool = True,
    hashed: Callable[..., Column] = F.xxhash64,
) -> DataFrame:
    """Replace the natural key columns by the dimension's id; null where there is none.

    No broadcast is forced. The dimension is a written table of known size, so Spark broadcasts
    it below ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges above, where adaptive
    execution splits the partitions of hot keys. ``match_nulls`` also matches tuples with nulls.

    Rows meet by one hash of the tuple, which is shorter to sort and to hold than its texts and
    needs no care for nulls; the parts are compared as well, so equal hashes do no harm.
    """
    right = _right_side(dimension, keys, id_name, hashed)
    pairs = ((F.col(k), F.col(f"_{k}")) for k in keys)
    same = reduce(and_, (a.eqNullSafe(b) if match_nulls else a == b for a, b in pairs))
    meet = hashed(*(df[k] for k in keys)) == F.col("_hash")
    return df.join(right, meet & same, "left").drop(*keys, "_hash", *(f"_{k}" for k in keys))
