"""Random-projection forest against all pairs."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimloom.llm import common, forest

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, first_id=0):
    rows = [
        (i, v if v is None else [None if x is None else float(x) for x in v], 0)
        for i, v in enumerate(vectors, first_id)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def by_pairs(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of links and least linked row of every row."""
    units = forest.unit(vectors.astype("f4"))
    links = units @ units.T >= 0.9
    np.fill_diagonal(links, False)
    return links.sum(axis=1), forest.least_connected(links)


def clusters(rng, sizes, length=24, noise=0.02):
    """Groups of near copies around random directions."""
    groups = []
    for size in sizes:
        middle = rng.normal(size=length)
        middle /= np.linalg.norm(middle)
        groups.append(middle + noise * rng.normal(size=(size, length)))
    return np.concatenate(groups).astype("f4")


def results(df) -> dict[int, tuple]:
    rows = df.collect()
    assert len({r["vec_id"] for r in rows}) == len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


def test_recall_of_links_and_components(spark, monkeypatch):
    """Many small groups, of cosines from below to far above the threshold."""
    monkeypatch.setattr(forest, "CELL", 400)
    rng = np.random.default_rng(2)
    some = [clusters(rng, [int(n)] * 8, 32, s) for n in (2, 5, 20) for s in (0.01, 0.04, 0.05, 0.06)]
    vectors = np.concatenate([*some, rng.normal(size=(2500, 32))])
    rng.shuffle(vectors)
    links, least = by_pairs(vectors)
    got = results(forest.near_duplicates(frame(spark, vectors), leaf=64))
    found = np.array([got[i][0] for i in range(len(vectors))])
    assert links.sum() > 3000
    assert (found <= links).all() and found.sum() >= 0.95 * links.sum()
    same = np.array([got[i][1] for i in range(len(vectors))]) == least
    assert same[links > 0].mean() >= 0.95 and same[links == 0].all()


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_third_near_copies_and_a_third_exact_copies(spark, monkeypatch, broadcast):
    """Balls find all links of a dense group, however many; its shell is compared in blocks."""
    monkeypatch.setattr(forest, "BLOCK", 100)
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    rng = np.random.default_rng(4)
    dense = clusters(rng, [700, 150], 24, 0.03)
    around = dense[:1] + 0.09 * rng.normal(size=(200, 24))
    copies = np.repeat(rng.normal(size=(1, 24)), 900, axis=0)
    vectors = np.concatenate([dense, around, copies, rng.normal(size=(700, 24))]).astype("f4")
    rng.shuffle(vectors)
    links, least = by_pairs(vectors)
    got = results(forest.near_duplicates(frame(spark, vectors), leaf=50))
    found = np.array([got[i][0] for i in range(len(vectors))])
    assert (found <= links).all() and found.sum() >= 0.999 * links.sum()
    assert (found >= 0.99 * links)[links >= 700].all()
    assert np.mean([got[i][1] == least[i] for i in range(len(vectors))]) >= 0.99


def test_two_balls_side_by_side_count_their_pairs_once(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 64)
    rng = np.random.default_rng(8)
    middle, aside = np.eye(16)[0], np.eye(16)[1]
    for angle in (0.2, 0.4, 0.45):
        other = np.cos(angle) * middle + np.sin(angle) * aside
        both = [m + 0.012 * rng.normal(size=(300, 16)) for m in (middle, other)]
        vectors = np.concatenate([*both, rng.normal(size=(100, 16))]).astype("f4")
        links, least = by_pairs(vectors)
        got = results(forest.near_duplicates(frame(spark, vectors)))
        assert [got[i][0] for i in range(600)] == links[:600].tolist()
        assert [got[i][1] for i in range(600)] == least[:600].tolist()


def test_pairs_count_in_the_first_leaf_they_share(spark, monkeypatch):
    """With leaves as large as the table every pair meets in every tree."""
    monkeypatch.setattr(forest, "DENSE", 10**9)
    monkeypatch.setattr(forest, "RECALL", 2.0)
    monkeypatch.setattr(forest, "MOST_TREES", 16)
    vectors = clusters(np.random.default_rng(5), [40, 30, 3, 1, 1], 8, 0.05)
    links, least = by_pairs(vectors)
    got = results(forest.near_duplicates(frame(spark, vectors)))
    assert got == {i: (n, a) for i, (n, a) in enumerate(zip(links, least, strict=True))}


def test_trees_are_added_until_the_sample_finds_its_links(spark, monkeypatch):
    asked = []
    share = forest.share_met
    monkeypatch.setattr(forest, "DENSE", 10**9)
    monkeypatch.setattr(forest, "TREES", 2)
    monkeypatch.setattr(forest, "share_met", lambda *a: asked.append(share(*a)) or asked[-1])
    vectors = clusters(np.random.default_rng(6), [3] * 500, 16, 0.085)
    forest.near_duplicates(frame(spark, vectors), leaf=6).collect()
    assert len(asked) > 1 and asked[-1] >= forest.RECALL > asked[0]
    assert asked == sorted(asked)


def test_leaves_cover_their_cell_and_cells_their_rows():
    units = forest.unit(np.random.default_rng(1).normal(size=(500, 8)))
    leaves = list(forest.leaves_below(units, 3, 2, 10))
    assert max(map(len, leaves)) <= 10 and set(np.concatenate(leaves)) == set(range(500))
    equal = np.repeat(units[:1], 300, axis=0)
    assert max(map(len, forest.leaves_below(equal, 3, 0, 10))) <= 10
    tree = forest.UpperTree(5, units, 60)
    cells = dict(tree.reached(units))
    assert len(cells) == tree.cells > 8 and set(np.concatenate(list(cells.values()))) == set(range(500))
    assert forest.UpperTree(5, equal, 60).cells == 1


def test_unusable_rows_repeated_ids_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        [1, 0, 0], None, [0, 0, 0], [nan, 1, 1], [inf, 1, 1], [1, 1], [1, 0.1, 0], [0, 1, 0],
        [1, None, 0], [], [3e38, 0, 0], [-0.0, 1e-38, 0], [0, 0, 5],
    ]
    extra = [(None, [0.0, 1.0, 0.0], 0), (7, [0.0, 1.0, 0.0], 0), (None, [0.0, 0.0, -1.0], 0)]
    rows = frame(spark, vectors).unionByName(spark.createDataFrame(extra, SCHEMA))
    rows = rows.withColumns({"node": F.lit(1), "vector": F.lit("x"), "n_links": F.lit(9)})
    got = [tuple(r) for r in forest.near_duplicates(rows).collect()]
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 8, 9, 12)]
    want = [(0, 2, 0, True), (6, 2, 0, False), (10, 2, 0, False)]
    want += [(7, 3, 7, True), (7, 3, 7, True), (None, 3, 7, False), (11, 3, 7, False)]
    want += [(None, 0, None, True)]
    assert sorted(got, key=str) == sorted(alone + want, key=str)
    assert forest.near_duplicates(rows.limit(0)).collect() == []
    assert len(forest.near_duplicates(rows.where("vec_id in (1, 2, 3)")).collect()) == 3
    doubles = spark.createDataFrame([(1, [1e300, 1.0]), (2, [1e-300, 0.0])], "vec_id long, embedding array<double>")
    assert results(forest.near_duplicates(doubles)) == {1: (1, 1), 2: (1, 1)}
