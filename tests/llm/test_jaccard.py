"""Jaccard join against all pairs."""

from __future__ import annotations

import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

from dimloom.llm import common, graph, jaccard
from tests.llm.helpers import documents, edited, odd_documents, words


def shingles(text: str | None) -> frozenset:
    found = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())]
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def by_pairs(texts: list[str | None]) -> dict[int, tuple[int, int, int]]:
    sets = [shingles(t) for t in texts]
    links, near = defaultdict(int), defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links[i] += 1
                links[j] += 1
                near[i].add(j)
                near[j].add(i)
    least: dict[int, int] = {}
    for i in range(len(sets)):
        todo = [i]
        while todo:
            at = todo.pop()
            if at not in least:
                least[at] = i
                todo += near[at]
    return {i: (len(s), least[i], links[i]) for i, s in enumerate(sets)}


def corpus(rng: random.Random) -> list[str | None]:
    passage = words(rng, 70)
    texts: list[str | None] = []
    for size in (5, 6, 8, 12, 40, 90, 200):
        for _ in range(4):
            base = words(rng, size)
            texts += [" ".join(base)] * rng.randint(1, 3)
            for changes in range(1, 5):
                texts.append(" ".join(edited(rng, base, changes)))
            texts.append(" ".join(base[: int(size * rng.uniform(0.75, 1))]))
    for _ in range(30):  # share a passage, but no more
        texts.append(" ".join(words(rng, rng.randint(10, 150)) + passage + words(rng, 20)))
    chain = words(rng, 150)  # each linked to the next only
    for step in range(12):
        texts.append(" ".join(chain[step * 5 : step * 5 + 90]))
    texts += ["", None, " \n", "one", "One", "one two", "a b c d", "A b  c d", "a b c d e"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("region", [jaccard.REGION, 400])
def test_equals_all_pairs(spark, monkeypatch, region):
    """With a small region size, families are cut into cells, bands and parts."""
    monkeypatch.setattr(jaccard, "REGION", region)
    texts = corpus(random.Random(8))
    rows = jaccard.jaccard_components(documents(spark, texts)).collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert len(rows) == len(texts) and got == by_pairs(texts)


def test_sets_of_four_shingles_equal_all_pairs(spark):
    rng = random.Random(4)
    texts: list[str | None] = []
    for _ in range(6):
        base = words(rng, 8)
        texts += [" ".join(base), " ".join([*base, "last"]), " ".join(["first", *base])]
    for length in (8, 9, 30, 400):  # words that repeat with period 4, and one more
        cycle = [f"w{length}x{i}" for i in range(4)] * 100
        texts += [" ".join(cycle[:length]), " ".join([*cycle[:length], "more"])]
    texts += ["p q r p q r p q r p", "p q r p q r p q r p more", "a b c d e f g", "a b c d e f g h"]
    want = by_pairs(texts)
    assert sum(links > 0 for n, _, links in want.values() if n == 4) >= 10
    rows = jaccard.jaccard_components(documents(spark, texts)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want


def test_a_dense_group_of_near_copies_with_and_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "REGION", 3000)
    rng = random.Random(3)
    base = words(rng, 60)
    texts = [" ".join(base)] * 40 + [" ".join(edited(rng, base, rng.randint(0, 2))) for _ in range(160)]
    texts += [" ".join(words(rng, 50)) for _ in range(50)]
    want = by_pairs(texts)
    for size in (common.BROADCAST_BYTES, 0):
        monkeypatch.setattr(common, "BROADCAST_BYTES", size)
        rows = jaccard.jaccard_components(documents(spark, texts)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want


@pytest.mark.parametrize("matrix", [True, False])
def test_a_region_of_one_or_two_parts_equals_all_pairs(monkeypatch, matrix):
    monkeypatch.setattr(jaccard, "CELLS", 1 << 25 if matrix else 0)
    monkeypatch.setattr(jaccard, "ROWS_AT_ONCE", 7)
    rng = random.Random(9)
    for roles in (1, 2):
        sets = []
        for base in (range(40), range(20, 70), range(100, 112)):
            for _ in range(25):
                gone = set(rng.sample(list(base), rng.randint(0, 4)))
                more = {rng.randrange(1000, 1100) for _ in range(rng.randint(0, 3))}
                sets.append(np.array(sorted((set(base) - gone) | more), dtype=np.uint64))
        role = np.array([rng.randrange(roles) for _ in sets])
        copies = np.array([rng.randint(1, 3) for _ in sets])
        sizes = np.array([len(s) + rng.randint(0, 1) for s in sets])  # one that no other holds
        nodes = np.array(rng.sample(range(-500, 500), len(sets)))
        region = jaccard.Region(nodes, sets, sizes, copies, role)
        links = dict.fromkeys(nodes.tolist(), 0)
        least = {int(n): int(n) for n in nodes}
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                near = 100 * both >= 80 * (sizes[i] + sizes[j] - both)
                if near and (roles == 1 or role[i] != role[j]):
                    links[nodes[i]] += copies[j]
                    links[nodes[j]] += copies[i]
                    one, other = least[nodes[i]], least[nodes[j]]
                    least = {n: min(one, other) if x in (one, other) else x for n, x in least.items()}
        got = list(zip(*(x.tolist() for x in region.joined()), strict=True))
        assert sorted(got) == sorted((n, least[n], links[n]) for n in least)
        assert max(links.values()) > 10


def near_copies(count: int, own_words: int) -> list[str]:
    """Texts of the same words but for the last ones."""
    base = " ".join(f"w{i}" for i in range(60))
    return [" ".join([base, *(f"own{k}x{i}" for k in range(own_words))]) for i in range(count)]


def test_very_many_near_copies_are_few_classes(spark):
    """Classes are counted by their size, whatever their number of sets."""
    texts = near_copies(2000, 1) + near_copies(2000, 2) + near_copies(1000, 40)
    rows = jaccard.jaccard_components(documents(spark, texts)).collect()
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in rows}
    # 56 shingles are shared: of 57 and 58 enough, of 96 too few.
    assert got == {i: (0, 3999) if i < 4000 else (i, 0) for i in range(5000)}


def test_a_task_of_very_many_near_copies_is_quick():
    """Sets of eleven shingles that differ in the last, and ones that differ in two places."""
    count = 8000
    sets = [np.array([*range(10), 100 + i], dtype=np.uint64) for i in range(count)]
    rng = np.random.default_rng(1)
    places = rng.integers(0, 300, size=(count, 2))
    sets += [np.setdiff1d(np.arange(1000, 1300), 1000 + p).astype(np.uint64) for p in places]
    ones = np.ones(len(sets), dtype=np.int64)
    began = time.perf_counter()
    sizes = np.array([11] * count + [300] * count)
    _, least, links = jaccard.Region(np.arange(2 * count), sets, sizes, ones, 0 * ones).joined()
    assert time.perf_counter() - began < 20
    assert (links == count - 1).all() and set(least.tolist()) == {0, count}


@pytest.mark.parametrize("frequent", [2, 5, 10**9])
def test_frequent_shingles_change_nothing(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    texts = corpus(random.Random(8))
    rows = jaccard.jaccard_components(documents(spark, texts)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == by_pairs(texts)


def test_a_shingle_that_all_sets_hold_is_dealt_to_many_tasks(spark):
    rows = [(i, 60, [7, 8, 10 + i]) for i in range(4000)]
    sets = spark.createDataFrame(rows, "node long, n long, keys array<long>")
    often = jaccard.frequent(sets)
    assert {r["key"]: r["parts"] for r in often.collect()} == {7: 125, 8: 125}
    dealt = jaccard.shingle_rows(sets, often).groupBy("key", "part").count()
    assert dealt.agg({"count": "max"}).first()[0] < 100
    assert {r["key"] for r in jaccard.met(jaccard.shingle_rows(sets, often)).collect()} == {7, 8}


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)]
    edges += [(300 + i, 300 + (i + 1) % 30) for i in range(30)] + [(5, 5)]
    rng.shuffle(edges)
    frame = spark.createDataFrame(edges, "a long, b long")
    rows = graph.components(frame).collect()
    got = {r["node"]: r["component"] for r in rows}
    want = {i: 0 for i in range(101)} | {i: 200 for i in range(200, 260)}
    assert len(rows) == len(got) and got == want | {300 + i: 300 for i in range(30)}
    assert graph.components(frame.limit(0)).collect() == []


def test_one_of_each_group(spark):
    rng = random.Random(2)
    base = " ".join(words(rng, 40))
    near = base + " more"
    docs = documents(spark, [base, near, "other text of its own here", "", "", None, base])
    assert sorted(r["doc_id"] for r in jaccard.one_of_each_group(docs).collect()) == [0, 2, 3, 4, 5]


def test_odd_rows_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = jaccard.jaccard_components(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["n_shingles"] == 2 and r["doc_id"]} == {1}
    assert jaccard.jaccard_components(odd.limit(0)).collect() == []
    kept = jaccard.one_of_each_group(odd)
    assert kept.schema == odd.schema
    # The repeated row goes once; the texts without words all stay.
    assert kept.count() == odd.count() - 1
    assert jaccard.one_of_each_group(odd.limit(0)).collect() == []
