"""Sharding by a permutation of row numbers."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest

from dimloom.llm import shards
from tests.invented import plan
from tests.llm.helpers import documents, odd_documents


@pytest.mark.parametrize("rows", [1, 2, 5, 10, 101, 1000])
def test_positions_are_a_permutation(spark, rows):
    numbered = spark.range(rows)
    moved = [r["id"] for r in shards.shuffled_positions(numbered, "id", rows, seed=7).collect()]
    assert sorted(moved) == list(range(rows))


def by_definition(number: int, rows: int, seed: int) -> int:
    side = shards.square_side(rows)
    while True:
        left, right = divmod(number, side)
        for add, times, plus in shards.round_keys(seed):
            start = (right + add) % shards.PRIME
            mixed = (start * start % shards.PRIME * times + plus) % shards.PRIME
            left, right = right, (left + mixed) % side
        number = left * side + right
        if number < rows:
            return number


def test_places_follow_from_the_row_number_alone(spark):
    rows = 777
    numbered = spark.range(rows).selectExpr("id", "id as was")
    moved = shards.shuffled_positions(numbered, "id", rows, seed=3).collect()
    assert all(r["id"] == by_definition(r["was"], rows, 3) for r in moved)


def test_shards_are_even_slots_have_no_gaps_and_runs_agree(spark):
    docs = documents(spark, [f"text {i} é" * (i % 5) for i in range(203)])
    first = shards.assign_shards(docs, 8)
    rows = {r["doc_id"]: r for r in first.collect()}
    again = {r["doc_id"]: r for r in shards.assign_shards(docs.repartition(7), 8).collect()}
    assert rows == again
    sizes = Counter(r["shard"] for r in rows.values())
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        slots = sorted(r["slot"] for r in rows.values() if r["shard"] == shard)
        assert slots == list(range(size))
    for i, row in rows.items():
        text = (f"text {i} é" * (i % 5)).encode()
        assert (row["size"], row["text_crc32"]) == (len(text) + 1, zlib.crc32(text))


def test_another_seed_gives_another_order(spark):
    docs = documents(spark, ["a"] * 64)
    one, two = (
        [(r["doc_id"], r["shard"], r["slot"]) for r in shards.assign_shards(docs, 4, seed).collect()]
        for seed in (1, 2)
    )
    assert sorted(one) != sorted(two)


def test_odd_rows_empty_tables_and_no_python_worker(spark):
    odd = odd_documents(spark)
    placed = shards.assign_shards(odd, 8)
    assert placed.count() == odd.count()
    assert placed.where("doc_id = 4").first()["size"] == 1
    assert shards.assign_shards(odd.limit(0), 8).collect() == []
    assert "Python" not in plan(placed) and "Arrow" not in plan(placed)
