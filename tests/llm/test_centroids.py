"""Clustering by lookup tables against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from dimloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, rows):
    as_doubles = [(i, v and [x if x is None else float(x) for x in v], 0) for i, v in rows]
    return spark.createDataFrame(as_doubles, SCHEMA).repartition(5)


def plain(rows, clusters, rounds, scale, seed=3):
    """Rows (id, vector) that take part; result by place in the list."""
    whole = [[math.floor(scale * x) for x in v] for _, v in rows]
    turn = sorted(
        range(len(rows)),
        key=lambda i: (
            rows[i][0] is None,
            hashlib.sha256(f"{seed}:{rows[i][0]}".encode()).hexdigest(),
            whole[i],
        ),
    )
    middles = [whole[i] for i in turn[:clusters]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, m, strict=True)) for m in middles]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        owner = [nearest(v)[0] for v in whole]
        for k in range(len(middles)):
            members = [v for v, o in zip(whole, owner, strict=True) if o == k]
            if members:
                middles[k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    last = [nearest(v) for v in whole]
    told = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    each = [sum(far for o, far in last if o == k) for k in range(len(middles))]
    return [
        (rows[i][0], k, far, each[k], sum(each), told[k]) for i, (k, far) in enumerate(last)
    ]


def as_sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("block", [centroids.BLOCK_ROWS, 7])
def test_equals_plain_python(spark, block):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [0.25, -0.5, 0, 0, 1, 1]) for i in range(70)]  # one hot vector
    rows += [(7, [9.0] * 6), (7, [-9.0] * 6), (None, [0.1] * 6), (None, [0.1] * 6)]
    got = centroids.centroid_clusters(frame(spark, rows), 4, 5, 1024, 6, block_rows=block).collect()
    assert as_sorted(got) == as_sorted(plain(rows, 4, 5, 1024))


def test_values_beyond_small_tables(spark):
    """Large numbers are computed exactly; what does not fit a long is null."""
    rows = [(i, [float(i % 3), 2.0**16 * i]) for i in range(40)]
    got = centroids.centroid_clusters(frame(spark, rows), 3, 4, 1024, 2).collect()
    assert as_sorted(got) == as_sorted(plain(rows, 3, 4, 1024))
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [1e200, 1.0]), (4, [1e308, 0.0])]
    far = centroids.centroid_clusters(frame(spark, rows), 1, 2, 1024, 2).collect()
    assert sorted(r["vec_id"] for r in far) == [1, 2, 3]
    assert all(r["distance"] is None and r["inertia"] is None for r in far)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [1.0, 1.0]) for i in range(9)]
    got = centroids.centroid_clusters(frame(spark, rows), 8, 3, 1024, 2).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)}
    assert as_sorted(got) == as_sorted(plain(rows, 8, 3, 1024))


def test_odd_rows_few_rows_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    good = [(4, [0.5, -0.5]), (None, [0.0, 0.0]), (5, [0.25, 0.25])]
    odd = [(1, None), (2, [1.0]), (3, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, inf]), (8, [])]
    docs = frame(spark, good + odd).withColumns(
        {"cluster": F.lit("x"), "distance": F.lit(None), "turn": F.lit(1), "vector": F.lit(2)}
    )
    got = centroids.centroid_clusters(docs, 8, 2, 1024, 2)
    assert as_sorted(got.collect()) == as_sorted(plain(good, 8, 2, 1024))
    none = centroids.centroid_clusters(docs.limit(0), 8, 2, 1024, 2)
    assert none.collect() == [] and none.dtypes == got.dtypes
    assert centroids.centroid_clusters(docs.where("vec_id = 1"), 8, 2, 1024, 2).collect() == []


def test_a_round_sends_the_driver_sums_only(spark, monkeypatch):
    """As many rows as clusters, dimensions and limbs, whatever the table holds."""
    taken = []
    moved = centroids.moved
    monkeypatch.setattr(centroids, "moved", lambda *a: taken.append(moved(*a)) or taken[-1])
    rows = [(i, [i / 7, -i / 5, 0.5]) for i in range(3000)]
    centroids.centroid_clusters(frame(spark, rows), 4, 3, 1024, 3).collect()
    assert [(len(m), len(m[0])) for m in taken] == [(4, 3)] * 3


def test_limbs_of_whole_numbers():
    for value in (0, 1, -1, 2**32, -(2**32) - 5, 10**40, -(10**40)):
        digits = centroids.limbs(value)
        assert sum(d << (32 * i) for i, d in enumerate(digits)) == value
        assert all(abs(d) < 2**32 for d in digits)
