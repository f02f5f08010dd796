"""Approximate nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised on their own, each to one of so many centroids that a pair of
them, a cell, holds about ``CELL_ROWS`` rows. For a query, a heap yields the cells by the sum of the
two half distances until the cells reached hold a share of all rows; the entries of those cells are
scored exactly. Centroids come from a sample of ``SAMPLE_ROWS`` at most; every row is indexed. The
share, and whether the distance counts the centroids' norms, are calibrated on
``CALIBRATION_QUERIES`` rows, whose true neighbours among all rows are found by comparing them with
every row: the share has to reach ``CALIBRATED_RECALL`` of them.

Cells are put together into blocks of at most ``BLOCK_ROWS`` rows; a larger cell is dealt to several
blocks by a random number of the row, so neither a vector nor an id that very many rows share is a
hot spot. A query goes to the blocks that hold a cell it wants, with the distance up to which it
wants cells. Queries are dealt to parts by their own cell, so that those of a part want similar
blocks, and an entry goes only to the parts that want its block. A task holds one block of entries
and streams the queries of one part past it; only the best of each query leave it.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id; rows that repeat an id are
candidates each, but no row is a candidate for a query of its own id, and a repeated query id is
answered once, by its smallest vector; such rows do not count among those a query has reached.
Ties go to the smaller id, and rows equal in id and score are ranked one after the other; fewer
candidates than wanted are all returned, and without any there are no rows, nor for an empty
table. Other columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.llm.common import in_small_batches, prepare, small_enough, stored

CELL_ROWS = 64
CENTROIDS = 16, 1024  # of a half, at least and at most
SAMPLE_ROWS = 16_384
CALIBRATION_QUERIES = 256
CALIBRATED_RECALL = 0.96
# A sixteenth of all rows, but at least and at most so many.
BLOCK_ROWS = 4096, 131_072
QUERY_ROWS = 32_768  # queries of a part
SCORES_AT_ONCE = 1 << 22
ROUNDS = 12
_STEPS = 1 << 30


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    some = F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & finite & some)


def k_means(rows: np.ndarray, count: int) -> np.ndarray:
    """Centroids from evenly spaced distinct rows, moved to their means a fixed number of times."""
    distinct = np.unique(rows, axis=0)
    chosen = np.linspace(0, len(distinct) - 1, min(count, len(distinct))).astype(int)
    centroids = distinct[chosen]
    for _ in range(ROUNDS):
        nearest = closest(rows, centroids)
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
    return centroids


def closest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1) - 2 * rows @ centroids.T, axis=1)


def centroid_count(rows: int, sampled: int) -> int:
    """Of each half, for cells of about ``CELL_ROWS`` rows."""
    least, most = CENTROIDS
    return int(np.clip(np.sqrt(rows / CELL_ROWS), least, min(most, max(least, sampled // 16))))


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of both halves, the weight of their norms in a distance, the share to visit."""

    first: np.ndarray
    second: np.ndarray
    norms: float = 0.0
    share: float = 1.0

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def cell_of(self, rows: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return closest(rows[:, :half], self.first) * len(self.second) + closest(
            rows[:, half:], self.second
        )

    def half_distances(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return (
            self.norms * (self.first**2).sum(axis=1) - 2 * self.first @ query[:half],
            self.norms * (self.second**2).sum(axis=1) - 2 * self.second @ query[half:],
        )

    def traverse(self, query: np.ndarray) -> Iterator[int]:
        """Cells by rising sum of the half distances."""
        one, other = self.half_distances(query)
        by_one, by_other = np.argsort(one, kind="stable"), np.argsort(other, kind="stable")
        a, b = one[by_one].tolist(), other[by_other].tolist()
        heap = [(a[0] + b[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(by_one[i]) * len(b) + int(by_other[j])
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))

    def limit(self, query: np.ndarray, sizes: np.ndarray, least: int) -> float:
        """The distance of the last cell a query visits: those up to it hold the share of all
        rows, and ``least`` more."""
        goal = self.share * sizes.sum() + least
        reached = 0
        for cell in self.traverse(query):
            reached += sizes[cell]
            if reached >= goal:
                return float(self.cell_distances(query, np.array([cell]))[0])
        return np.inf

    def cell_distances(self, query: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The sums of the half distances of some cells."""
        one, other = self.half_distances(query)
        first, second = np.divmod(cells, len(self.second))
        return one[first] + other[second]

    def calibrated(
        self, sizes: np.ndarray, queries: np.ndarray, neighbours: list[np.ndarray]
    ) -> MultiIndex:
        """The same centroids with the smaller share that reaches the recall, from the cells of
        the true neighbours of some queries."""
        trials = []
        for norms in (0.0, 1.0):
            trial = MultiIndex(self.first, self.second, norms)
            reached = [np.zeros(1)]
            for query, cells in zip(queries, neighbours, strict=True):
                far = trial.cell_distances(query, np.arange(self.cells))
                order = np.argsort(far, kind="stable")
                until = np.empty(self.cells)
                until[order] = np.cumsum(sizes[order])
                reached.append(until[cells] / sizes.sum())
            share = float(np.quantile(np.concatenate(reached), CALIBRATED_RECALL))
            trials.append(MultiIndex(self.first, self.second, norms, share))
        return min(trials, key=lambda trial: trial.share)


def vectors_of(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def block_table(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell, its first block and over how many blocks its rows are dealt."""
    first, parts = np.zeros(len(sizes), dtype=np.int32), np.ones(len(sizes), dtype=np.int32)
    block = filled = 0
    for cell, size in enumerate(sizes.tolist()):
        if size > most:
            block += filled > 0
            parts[cell] = -(-size // most)
            first[cell] = block
            block += int(parts[cell])
            filled = 0
            continue
        if filled + size > most:
            block, filled = block + 1, 0
        first[cell] = block
        filled += size
    return first, parts


class Block:
    """Entries that a task holds."""

    def __init__(self, index: MultiIndex, ids: np.ndarray, cells: np.ndarray, vectors: np.ndarray):
        self.index, self.ids, self.vectors = index, ids, vectors
        self.cells, self.places = np.unique(cells, return_inverse=True)
        self.longest = np.sqrt((vectors**2).sum(axis=1).max(initial=0))

    def best(
        self, ids: np.ndarray, vectors: np.ndarray, limits: np.ndarray, nearest: int
    ) -> pa.RecordBatch:
        """Rows (query_id, vec_id, score) of the nearest entries in the cells each query wants."""
        far = np.array([self.index.cell_distances(query, self.cells) for query in vectors])
        wanted = far <= limits[:, None]
        scores = vectors @ self.vectors.T
        scores[~wanted[:, self.places] | (ids[:, None] == self.ids)] = -np.inf
        least = np.full(len(ids), -np.inf)
        if len(self.ids) > nearest:
            least = -np.partition(-scores, nearest - 1, axis=1)[:, nearest - 1]
        # The product may round differently from the exact sum, so near ties stay in.
        slack = 1e-12 * np.sqrt((vectors**2).sum(axis=1)) * self.longest
        queries, entries = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
        exact = np.empty(len(queries))
        for at in range(0, len(queries), 1 << 15):
            some = slice(at, at + (1 << 15))
            exact[some] = (vectors[queries[some]] * self.vectors[entries[some]]).sum(axis=1)
        order = np.lexsort((self.ids[entries], -exact, queries))
        queries, entries, exact = queries[order], entries[order], exact[order]
        kept = np.arange(len(queries)) - np.searchsorted(queries, queries) < nearest
        queries, entries, exact = queries[kept], entries[kept], exact[kept]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[queries]), pa.array(self.ids[entries]), pa.array(exact)],
            names=["query_id", "vec_id", "score"],
        )


def true_neighbours(
    placed: DataFrame, ids: np.ndarray, vectors: np.ndarray, nearest: int
) -> list[np.ndarray]:
    """The cells of the nearest rows to each of a few queries, among all rows."""
    length = vectors.shape[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, 3))
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = vectors @ vectors_of(batch.column(1), length).T
            scores[ids[:, None] == batch.column(0).to_numpy()] = -np.inf
            at = np.argpartition(-scores, min(nearest, scores.shape[1]) - 1, axis=1)[:, :nearest]
            rows, at = np.repeat(np.arange(len(ids)), at.shape[1]), at.ravel()
            cells = batch.column(2).to_numpy()[at]
            found = np.stack([rows, -scores[rows, at], cells], axis=1)
            best = np.concatenate([best, found[found[:, 1] < np.inf]])
            best = best[np.lexsort((best[:, 1], best[:, 0]))]
            best = best[np.arange(len(best)) - np.searchsorted(best[:, 0], best[:, 0]) < nearest]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best[:, 0].astype(np.int64)),
                pa.array(-best[:, 1]),
                pa.array(best[:, 2].astype(np.int32)),
            ],
            names=["nth", "score", "cell"],
        )

    found = placed.select("vec_id", "vector", "cell").mapInArrow(
        in_small_batches(search), "nth long, score double, cell int"
    )
    order = Window.partitionBy("nth").orderBy(F.desc("score"), "cell")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    cells: list[list[int]] = [[] for _ in ids]
    for row in ranked.select("nth", "cell").collect():  # nearest rows for each of the queries
        cells[row["nth"]].append(row["cell"])
    return [np.array(c, dtype=np.int64) for c in cells]


def sampled(rows: DataFrame, there: int, most: int) -> pa.Table:
    """At most so many of the stored rows, by their random number, which no id or vector sways."""
    steps = min(_STEPS, (most + most // 8 + 64) * _STEPS // max(there, 1))
    some = rows.where(F.col("deal") < steps).orderBy("deal", "vec_id", "vector").limit(most)
    return some.select("vec_id", "vector").toArrow()


def fitted(
    rows: DataFrame, there: int, length: int, nearest: int
) -> tuple[MultiIndex, DataFrame, np.ndarray]:
    """The calibrated index, the stored rows with their cells, and how many a cell holds."""
    picked = sampled(rows, there, SAMPLE_ROWS)
    sample = vectors_of(picked.column("vector").combine_chunks(), length)
    count, half = centroid_count(there, len(sample)), length // 2
    index = MultiIndex(k_means(sample[:, :half], count), k_means(sample[:, half:], count))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = index.cell_of(vectors_of(batch.column(1), length))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int32())],
                names=["vec_id", "vector", "deal", "cell"],
            )

    schema = "vec_id long, vector array<double>, deal long, cell int"
    placed = stored(rows.mapInArrow(in_small_batches(cells), schema), "cells")
    sizes = np.zeros(index.cells, dtype=np.int64)
    for row in placed.groupBy("cell").count().toLocalIterator():  # at most all pairs of centroids
        sizes[row["cell"]] = row["count"]
    few = slice(0, CALIBRATION_QUERIES)
    ids, queries = picked.column("vec_id").to_numpy()[few], sample[few]
    known = true_neighbours(placed, ids, queries, nearest)
    return index.calibrated(sizes, queries, known), placed, sizes


def asked_blocks(
    queries: DataFrame,
    index: MultiIndex,
    sizes: np.ndarray,
    blocks: tuple[np.ndarray, np.ndarray],
    length: int,
    nearest: int,
) -> DataFrame:
    """Queries (part, vec_id, vector, times), once for each block that has a cell they want, with
    the distance up to which they want cells."""
    first, parts = blocks

    def wants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.flatnonzero(sizes)
        for batch in batches:
            found = vectors_of(batch.column(2), length)
            at, blocks, limits = [], [], []
            for row, (query, times) in enumerate(zip(found, batch.column(3).to_pylist(), strict=True)):
                limit = index.limit(query, sizes, nearest + times)
                cells = filled[index.cell_distances(query, filled) <= limit]
                spans = set(zip(first[cells].tolist(), parts[cells].tolist(), strict=True))
                own = sorted({b for start, n in spans for b in range(start, start + n)})
                at += [row] * len(own)
                blocks += own
                limits += [limit] * len(own)
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), *picked.columns[:3], pa.array(limits, pa.float64())],
                names=["block", "part", "vec_id", "vector", "reach"],
            )

    return queries.select("part", "vec_id", "vector", "times").mapInArrow(
        in_small_batches(wants),
        "block int, part int, vec_id long, vector array<double>, reach double",
    )


def dealt(rows: DataFrame, sizes: np.ndarray, most: int, name: str) -> tuple[DataFrame, tuple]:
    """Rows (cell, deal) with a block each, as a column of the given name, and the blocks."""
    first, parts = block_table(sizes, most)
    cells = np.arange(len(sizes), dtype=np.int32)
    table = pd.DataFrame({"cell": cells, "_first": first, "_of": parts})
    # One row a cell; there are at most CENTROIDS[1] ** 2 of them.
    known = rows.sparkSession.createDataFrame(table[sizes > 0], "cell int, _first int, _of int")
    block = (F.col("_first") + F.col("deal") % F.col("_of")).cast("int").alias(name)
    joined = rows.join(F.broadcast(known), "cell")
    return joined.select(block, *rows.columns), (first, parts)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    nearest: int = 20,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score: for each query the nearest entries by inner product.

    ``is_query`` is a condition on the column vec_id.
    """
    prepare(vectors.sparkSession)
    schema = "query_id long, vec_id long, score double"
    rows = usable(vectors, id_col, vector)
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), "length").first()
    if most is None:
        empty = vectors.sparkSession.createDataFrame([], schema)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    length, there = most["length"], most["count"]
    # Written once, so that all passes see the same random numbers.
    rows = stored(
        rows.where(F.size("vector") == length).withColumn(
            "deal", F.floor(F.rand(17) * _STEPS).cast("long")
        ),
        "rows",
    )
    index, placed, sizes = fitted(rows, there, length, nearest)
    block_rows = int(np.clip(there // 16, *BLOCK_ROWS))
    entries, blocks = dealt(placed, sizes, block_rows, "block")

    chosen = stored(
        placed.where(is_query)
        .groupBy("vec_id")
        .agg(
            F.min(F.struct("vector", "cell", "deal")).alias("least"), F.count("*").alias("times")
        )
        .select("vec_id", "least.*", "times"),
        "queries",
    )
    asking = np.zeros(index.cells, dtype=np.int64)
    for row in chosen.groupBy("cell").count().toLocalIterator():
        asking[row["cell"]] = row["count"]
    queries, _ = dealt(chosen, asking, QUERY_ROWS, "part")
    asked = stored(asked_blocks(queries, index, sizes, blocks, length, nearest), "asked")
    # Which parts want a block; an entry goes to those only.
    pairs = stored(asked.select("block", "part").distinct(), "pairs")
    offered = entries.join(F.broadcast(pairs) if small_enough(pairs, 32) else pairs, "block")
    both = asked.select(
        "block", "part", F.lit(1).alias("role"), "vec_id", "vector", F.lit(0).alias("cell"), "reach"
    ).unionByName(
        offered.select(
            "block",
            "part",
            F.lit(0).alias("role"),
            "vec_id",
            "vector",
            "cell",
            F.lit(None).cast("double").alias("reach"),
        )
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block and part, entries before queries."""
        pair, block, held = None, None, []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if begin == end:
                    continue
                some = batch.slice(begin, end - begin)
                if pair != (keys[begin, 0], keys[begin, 1]):
                    pair, block, held = (keys[begin, 0], keys[begin, 1]), None, []
                ids, found = some.column(3).to_numpy(), vectors_of(some.column(4), length)
                if keys[begin, 2] == 0:
                    held.append((ids, some.column(5).to_numpy(), found))
                    continue
                if block is None:
                    if not held:
                        continue
                    block = Block(index, *(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
                limits = some.column(6).to_numpy()
                step = max(1, SCORES_AT_ONCE // len(block.ids))
                for at in range(0, len(ids), step):
                    part = slice(at, at + step)
                    yield block.best(ids[part], found[part], limits[part], nearest)

    tasks = pairs.count()
    found = (
        both.repartition(max(1, min(tasks, 100_000)), "block", "part")
        .sortWithinPartitions("block", "part", "role")
        .mapInArrow(in_small_batches(search), schema)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
