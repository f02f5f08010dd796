from __future__ import annotations

from invented import plan, rows
from pyspark.sql import functions as F

from dimloom.operators import distinct_rows, one_per_key


def test_newest_row_wins_and_other_columns_break_ties(spark):
    data = [
        ("a", 1, "x"),
        ("a", 2, "x"),
        ("a", 2, "y"),
        ("b", None, "z"),
        ("b", 0, None),
        (None, 5, "n"),
        (None, 4, "n"),
    ]
    frame = spark.createDataFrame(data, "k string, seen int, v string")
    assert rows(one_per_key(frame, ["k"], ["seen"])) == {
        ("a", 2, "y"),
        ("b", 0, None),
        (None, 5, "n"),
    }


def test_composite_key(spark):
    data = [("i", "p", 1), ("i", "p", 2), ("i", "q", 0)]
    frame = spark.createDataFrame(data, "a string, b string, c int")
    assert rows(one_per_key(frame, ["a", "b"])) == {("i", "p", 2), ("i", "q", 0)}


def test_only_key_columns(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(one_per_key(frame, ["k"])) == {("a",), ("b",)}


def test_survivor_does_not_depend_on_partitioning(spark):
    frame = spark.range(5000).select(
        (F.col("id") % 37).alias("k"),
        (F.col("id") % 5).alias("seen"),
        F.hash("id").alias("v"),
    )
    expected = rows(one_per_key(frame.coalesce(1), ["k"], ["seen"]))
    assert rows(one_per_key(frame.repartition(8), ["k"], ["seen"])) == expected
    assert rows(one_per_key(frame.orderBy(F.rand(3)), ["k"], ["seen"])) == expected


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with a third of the rows reaches its reducer as one row per map task."""
    size, tasks = 60_000, 6
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    frame = spark.range(0, size, 1, tasks).select(hot.alias("k"), F.hash("id").alias("v"))
    survivors = one_per_key(frame, ["k"])
    assert survivors.count() == 1 + size - size // 3
    text = plan(survivors)
    tree = text[: text.index("(1) Range")]
    first_limit, exchange = tree.rindex("WindowGroupLimit"), tree.rindex("Exchange")
    assert tree.count("WindowGroupLimit") == 2
    assert exchange < first_limit  # printed below the exchange: it runs before it


def test_distinct_rows_reads_only_its_columns(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    pairs = distinct_rows(lines, ["l_returnflag", "l_linestatus"])
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in plan(pairs)
    assert pairs.count() == 6
