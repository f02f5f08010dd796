from __future__ import annotations

import random

import pytest
from invented import configured, plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimloom.operators import dense_ids, lookup_id
from dimloom.operators.keys import dense_ids_together, extended_ids
from dimloom.scratch import scratch_path

KEYS = ["a", "b", "c"]


def tuples(spark, seed, size=3000):
    """Key tuples with a hot leading value, repeats and nulls in every place."""
    pick = random.Random(seed)
    words = [None, "", " ", "A", "a", "b", "é", "zz"]

    def leading():
        return pick.choice(words) if pick.random() > 0.4 else "hot"

    data = [(leading(), pick.choice(words), pick.randrange(40)) for _ in range(size)]
    return spark.createDataFrame(data, "a string, b string, c int")


def global_numbering(df):
    order = Window.orderBy(*(F.col(k).asc_nulls_first() for k in KEYS))
    return df.select(*KEYS).distinct().withColumn("id", F.row_number().over(order).cast("long"))


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_one_global_window(spark, seed):
    frame = tuples(spark, seed)
    assert rows(dense_ids(frame, KEYS, "id"), "id", *KEYS) == rows(
        global_numbering(frame), "id", *KEYS
    )


@pytest.mark.parametrize("partitions", ["1", "3", "64"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ids_do_not_depend_on_partitioning(spark, partitions, adaptive):
    frame = tuples(spark, 5)
    expected = rows(dense_ids(frame, KEYS, "id"))
    with configured(spark, shuffle_partitions=partitions, adaptive_enabled=adaptive):
        shuffled = frame.repartition(7).orderBy(F.rand(1))
        numbered = dense_ids(shuffled, KEYS, "id")
        assert rows(numbered) == expected
        ids = sorted(r["id"] for r in numbered.collect())
    assert ids == list(range(1, len(ids) + 1))


def test_several_ranges_are_used_and_none_is_a_single_task(spark):
    """A leading value with two thirds of the tuples still spreads over the ranges."""
    frame = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("a"),
        F.col("id").alias("b"),
    )
    path = scratch_path(spark, "ranges")
    with configured(spark, adaptive_coalescePartitions_enabled="false"):
        numbered = dense_ids(frame, ["a", "b"], "id", path)
    written = spark.read.parquet(path)
    sizes = [
        r["count"]
        for r in written.groupBy(F.shiftright("_position", 33).alias("r")).count().collect()
    ]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    assert numbered.agg(F.max("id")).first()[0] == 20_000
    # The one window left is over the counts of the ranges.
    assert plan(numbered).count("SinglePartition") <= 1


def test_empty_input(spark):
    assert dense_ids(tuples(spark, 1).limit(0), KEYS, "id").collect() == []


def test_lookup_matches_nulls_only_when_asked(spark):
    data = [("x", "y"), ("x", None), (None, None), ("q", "q")]
    frame = spark.createDataFrame(data, "a string, b string")
    dimension = dense_ids(frame.filter("a is null or a = 'x'"), ["a", "b"], "id")
    named = frame.withColumn("row", F.concat_ws("|", "a", "b"))
    found = lookup_id(named, dimension, ["a", "b"], "id")
    assert rows(found, "row", "id") == {("", 1), ("x", 2), ("x|y", 3), ("q|q", None)}
    strict = lookup_id(named, dimension, ["a", "b"], "id", match_nulls=False)
    assert rows(strict, "row", "id") == {("", None), ("x", None), ("x|y", 3), ("q|q", None)}


def test_small_dimension_is_broadcast_by_its_size(spark):
    frame = tuples(spark, 3)
    found = lookup_id(frame, dense_ids(frame, KEYS, "id"), KEYS, "id")
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan(found)
    assert found.count() == frame.count()


def test_large_dimension_is_merged_and_hot_keys_are_split(spark):
    """Beyond the broadcast limit adaptive execution splits the partition of a hot tuple."""
    size = 60_000
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    frame = spark.range(0, size, 1, 8).select(
        hot.cast("string").alias("a"),
        (hot * 2).cast("string").alias("b"),
        F.uuid().alias("payload"),
    )
    dimension = dense_ids(frame, ["a", "b"], "id")
    with configured(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive_autoBroadcastJoinThreshold="-1",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="20KB",
        adaptive_skewJoin_skewedPartitionFactor="2",
        adaptive_advisoryPartitionSizeInBytes="20KB",
    ):
        found = lookup_id(frame, dimension, ["a", "b"], "id")
        collected = found.collect()
        assert len(collected) == size and all(r["id"] is not None for r in collected)
        assert "SortMergeJoin(skew=true)" in plan(found)


def test_frames_numbered_together_are_numbered_as_each_alone(spark):
    frame = tuples(spark, 8).withColumn("c", F.col("c").cast("string"))
    sources = {
        "three": (frame, KEYS, "id3"),
        "none": (frame.limit(0), ["a", "b"], "id0"),
        "two": (frame, ["b", "c"], "id2"),
        "one": (spark.range(5000).select(F.col("id").cast("string").alias("k")), ["k"], "id1"),
    }
    for partitions in ("1", "3", "64"):
        with configured(spark, shuffle_partitions=partitions):
            together = dense_ids_together(sources)
            for name, (df, keys, id_name) in sources.items():
                alone = dense_ids(df, keys, id_name)
                assert together[name].columns == alone.columns == [id_name, *keys]
                assert together[name].orderBy(id_name).collect() == alone.orderBy(id_name).collect()


def test_frames_numbered_together_are_sorted_and_written_once(spark):
    path = scratch_path(spark, "together")
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("l"))
    with configured(spark, adaptive_coalescePartitions_enabled="false"):
        dense_ids_together({"a": (keys, ["k"], "a_id"), "b": (keys, ["l", "k"], "b_id")}, path)
    written = spark.read.parquet(path)
    assert written.groupBy("_frame").count().orderBy("_frame").collect() == [(0, 4000), (1, 4000)]
    ranges = written.select(F.shiftright("_position", 33).alias("r"), "_frame").distinct()
    assert ranges.select("r").distinct().count() > 2


def test_kept_ids_stay_and_new_tuples_follow(spark):
    first, more = tuples(spark, 4, 60), tuples(spark, 9, 400)
    kept = dense_ids(first, KEYS, "id")
    grown = extended_ids(kept, first.unionByName(more), KEYS, "id")
    assert rows(kept, "id", *KEYS) <= rows(grown, "id", *KEYS)
    ids = sorted(r["id"] for r in grown.collect())
    assert ids == list(range(1, len(ids) + 1)) and len(ids) > kept.count()
    assert rows(grown, *KEYS) == rows(first.unionByName(more).distinct(), *KEYS)
    again = extended_ids(grown, first, KEYS, "id")
    assert rows(again) == rows(grown)
    assert rows(extended_ids(kept.limit(0), first, KEYS, "id")) == rows(kept)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("match_nulls", [True, False])
def test_lookups_whose_hashes_are_all_the_same(spark, threshold, match_nulls):
    frame = tuples(spark, 6, 300)
    dimension = dense_ids(frame, KEYS, "id")
    with configured(spark, autoBroadcastJoinThreshold=threshold):
        found = lookup_id(frame.withColumn("v", F.monotonically_increasing_id()), dimension, KEYS, "id", match_nulls)
        by_one_hash = lookup_id(
            frame.withColumn("v", F.monotonically_increasing_id()), dimension, KEYS, "id", match_nulls,
            hashed=lambda *_: F.lit(7).cast("long"),
        )
        assert found.count() == 300 and rows(found) == rows(by_one_hash)
        assert (found.where("id is null").count() == 0) == match_nulls
