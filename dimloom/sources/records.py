"""Records of delimited text whose quoted fields may hold line breaks, cut in parallel.

A line alone does not tell whether it starts inside a quoted field. What it tells is where it
ends if it starts outside one, and where if it starts inside one. These two answers compose: along
the lines of a split, and then along the splits of a file, of which there is one small row each.
Once the state at the start of every split is known, every line's own state is, and the lines from
one that starts outside to the next such line are a record. So a large file is read by as many
tasks as it has splits; nothing but records that go over several lines is put together, and no
text is parsed here.

A quote opens a field only where the field begins, is doubled inside it, and after the closing one
everything up to the separator still belongs to the field; that is how Spark reads them. Lines end
with a line feed, after which a carriage return may be cut off.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ["file", "split"]


def ends_inside(line: Column, separator: str) -> tuple[Column, Column]:
    """If a line ends inside a quoted field: given that it starts outside one, or inside one.

    The expressions are possessive, so a line is read once and never from the start again.
    """
    sep = re.escape(separator)
    quoted = '(?:[^"]++|"")*+'
    rest = f"[^{sep}]*+{sep}"  # up to the end of the field
    fields = f'(?:(?:"{quoted}"{rest})|(?:(?!"){rest}))*+'
    opens = f'{fields}"{quoted}\\z'
    from_outside = line.rlike(f"(?s)\\A{opens}")
    from_inside = line.rlike(f'(?s)\\A{quoted}(?:\\z|"{rest}{opens})')
    quotes = line.contains('"')
    return quotes & from_outside, ~quotes | from_inside


def _flipped(state: Column, times: Column) -> Column:
    return state != (times % 2 == 1)


def _state_before(
    rows: DataFrame, order: str, by: list[str], if_outside: str, if_inside: str
) -> DataFrame:
    """rows with ``known`` and ``state``: the state before each in its group.

    A row whose answers agree settles the state whatever came before it, one that has them
    crossed flips it, and all others keep it. Where nothing settled it yet, ``state`` says if the
    state at the start of the group has been flipped.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col(if_outside) == F.col(if_inside)
    flips = (F.col(if_outside) & ~F.col(if_inside)).cast("long")
    counted = rows.withColumn("_flips", F.coalesce(F.sum(flips).over(before), F.lit(0)))
    settled = F.when(settles, F.struct(F.col(if_outside).alias("state"), "_flips"))
    last = F.last(settled, ignorenulls=True).over(before)
    return (
        counted.withColumn("_last", last)
        .withColumns(
            {
                "known": F.col("_last").isNotNull(),
                "state": F.when(
                    F.col("_last").isNotNull(),
                    _flipped(F.col("_last.state"), F.col("_flips") - F.col("_last._flips")),
                ).otherwise(F.col("_flips") % 2 == 1),
            }
        )
        .drop("_flips", "_last")
    )


def _lines(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Lines with their place (file, split, nth) and, for both states that their split may start
    in, the state they start and end in and the line at which their record starts."""
    text = spark.read.option("lineSep", "\n").text(path)
    from_outside, from_inside = ends_inside(F.col("line"), separator)
    placed = text.select(
        F.col("value").alias("line"),
        # A path is longer than most lines, and is held with each of them.
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),  # rises along a split
    ).withColumns({"if_outside": from_outside, "if_inside": from_inside})
    in_turn = Window.partitionBy(*SPLIT).orderBy("at")
    numbered = placed.withColumn("nth", F.row_number().over(in_turn))
    told = _state_before(numbered, "at", SPLIT, "if_outside", "if_inside")
    starts, ends = {}, {}
    for given, state in (("outside", F.lit(False)), ("inside", F.lit(True))):
        start = F.when(F.col("known"), F.col("state")).otherwise(F.col("state") != state)
        starts[f"starts_{given}"] = start
        ends[f"ends_{given}"] = F.when(start, F.col("if_inside")).otherwise(F.col("if_outside"))
    told = told.withColumns(starts | ends)
    so_far = in_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    firsts = {
        f"first_{given}": F.last(
            F.when(~F.col(f"starts_{given}"), F.col("nth")), ignorenulls=True
        ).over(so_far)
        for given in ("outside", "inside")
    }
    return told.withColumns(firsts).drop("known", "state", "at", "if_outside", "if_inside")


def _splits(lines: DataFrame) -> DataFrame:
    """One row a split: if it starts inside a field, and in which split and line the record
    starts that was open there."""
    last = {
        name: F.max_by(name, "nth").alias(name)
        for name in ("ends_outside", "ends_inside", "first_outside", "first_inside")
    }
    splits = lines.groupBy(*SPLIT).agg(*last.values())
    told = _state_before(splits, "split", ["file"], "ends_outside", "ends_inside")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    first = F.when(F.col("state"), F.col("first_inside")).otherwise(F.col("first_outside"))
    opened = F.when(first.isNotNull(), F.struct(F.col("split").alias("split"), first.alias("nth")))
    # A file starts outside, so the state is the number of flips, odd or even, if nothing settled it.
    return told.withColumn("opened", F.last(opened, ignorenulls=True).over(before)).select(
        *SPLIT, F.col("state").alias("inside"), "opened"
    )


def read_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """record and is_first (of its file) of every record that is not empty."""
    lines = _lines(spark, path, separator)
    states = _splits(lines)

    def given(name: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{name}_inside")).otherwise(F.col(f"{name}_outside"))

    own = F.struct("split", given("first").alias("nth"))
    known = lines.join(states, SPLIT).select(
        *SPLIT,
        "nth",
        "line",
        F.when(given("first").isNotNull(), own).otherwise(F.col("opened")).alias("begin"),
        (~given("starts") & ~given("ends")).alias("alone"),
    )
    is_first = (F.col("begin.split") == 0) & (F.col("begin.nth") == 1)
    several = (
        known.where(~F.col("alone"))
        .groupBy("file", "begin")
        .agg(F.sort_array(F.collect_list(F.struct("split", "nth", "line"))).alias("lines"))
        .select(F.array_join("lines.line", "\n").alias("record"), is_first.alias("is_first"))
    )
    alone = known.where("alone").select(F.col("line").alias("record"), is_first.alias("is_first"))
    cut = alone.unionByName(several).withColumn("record", F.regexp_replace("record", "\r\\z", ""))
    return cut.where("record <> ''")
