"""Sharding: a Feistel permutation of global row numbers gives every row its shard and slot.

Rows are numbered 0 .. n-1 in a fixed order. A balanced Feistel network permutes the numbers
below ``side * side``, the smallest square that is not below n; results outside 0 .. n-1 walk on
along their cycle until they fall inside. Position p then belongs to shard ``p % shards`` at slot
``p // shards``, so shards differ by one row at most and slots have no gaps. Anyone who knows n
and the seed can compute the place of row number r without looking at other rows.

Only DataFrame functions are used. Defined results: a null text has size 1 and the check sum of
no bytes; null and repeated ids are rows like others; rows that tie in id, size and check sum are
numbered one after the other; an empty table gives an empty result; texts of any length are read
whole. Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import stored, whole
from dimloom.operators.keys import number_rows

PRIME = (1 << 31) - 1  # a square of a number below twice this still fits into 63 bits
ROUNDS = 6
SEED = 20_240_601


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three numbers a round, from a multiplicative generator started at the seed."""
    state, keys = seed % PRIME or 1, []
    for _ in range(ROUNDS):
        three = []
        for _ in range(3):
            state = state * 48271 % PRIME
            three.append(state)
        keys.append(tuple(three))
    return keys


def square_side(rows: int) -> int:
    return isqrt(max(rows - 1, 0)) + 1


def permuted(number: Column, side: int, seed: int) -> Column:
    """The image of a number from 0 to ``side * side - 1`` under the network."""
    keys = F.array(
        *(
            F.struct(F.lit(a).alias("add"), F.lit(t).alias("times"), F.lit(p).alias("plus"))
            for a, t, p in round_keys(seed)
        )
    )

    def one_round(halves: Column, key: Column) -> Column:
        start = (halves["right"] + key["add"]) % PRIME
        mixed = (start * start % PRIME * key["times"] + key["plus"]) % PRIME
        return F.struct(
            halves["right"].alias("left"), ((halves["left"] + mixed) % side).alias("right")
        )

    halves = F.struct(
        ((number - number % side) / side).cast("long").alias("left"),
        (number % F.lit(side)).alias("right"),
    )
    return F.aggregate(keys, halves, one_round, lambda h: h["left"] * side + h["right"])


def shuffled_positions(numbered: DataFrame, number: str, rows: int, seed: int) -> DataFrame:
    """Replace the row numbers 0 .. rows-1 by a permutation of the same numbers.

    Only the numbers from ``rows`` to the square, at most 2 * sqrt(rows) + 1 of them, can be met
    on a walk. Where each of them ends is worked out once in a small table, whose rows step on
    together until all are inside; one that comes back to its start is on a cycle no row is on,
    and goes. The row table joins it. That bounds its broadcast by the square root of the row
    count, 32 MB at 10^12 rows.
    """
    spark = numbered.sparkSession
    if not rows:
        return numbered
    side = square_side(rows)
    kept = [c for c in numbered.columns if c != number]
    once = numbered.select(*kept, permuted(F.col(number), side, seed).alias("_at"))
    ends = spark.range(rows, side * side).select(F.col("id").alias("_from"), "id")
    while True:
        step = permuted(F.col("id"), side, seed)
        inside = F.col("id") < rows
        ends = ends.select("_from", F.when(inside, F.col("id")).otherwise(step).alias("id"))
        ends = stored(ends.where("id != _from"), "walks")
        if ends.where(F.col("id") >= rows).isEmpty():
            break
    ends = F.broadcast(ends.withColumnRenamed("id", "_end"))
    walked = once.join(ends, F.col("_at") == F.col("_from"), "left")
    return walked.select(*kept, F.coalesce("_end", "_at").alias(number))


def assign_shards(
    docs: DataFrame, shards: int, seed: int = SEED, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    The order that numbers rows is id, size, check sum; rows equal in all three are
    interchangeable, so which of them gets which number does not show in the result.
    """
    measured = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(whole(text)).cast("long") + 1).alias("size"),
        F.crc32(whole(text).cast("binary")).alias("text_crc32"),
    ).withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "size", "text_crc32", "_tie")]
    numbered = number_rows(measured, order, "_number").drop("_tie")
    rows = numbered.count()
    placed = shuffled_positions(numbered, "_number", rows, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("_number") % shards).cast("int").alias("shard"),
        F.expr(f"_number div {shards}").alias("slot"),
    )
