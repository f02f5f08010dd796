"""Centroid clustering of whole-number vectors by scalar lookup tables.

Every component is floored to a multiple of 1/``scale``. A squared distance is then a sum of
squared differences of whole numbers, of which few different ones occur: a task tabulates them for
each dimension, each value that may occur and each centroid, once a round and block of rows, and a
distance is a sum of gathers from those tables. All sums are exact, so the result does not depend
on how the rows are dealt to tasks.

A round leaves a task as one sum for each centroid, dimension and 32-bit limb; Spark adds them up,
and the driver turns ``clusters`` times the length of a vector of them into the next centroids.
Between rounds nothing else is kept. A cluster that holds most rows costs a task no more than any
other. Blocks with values beyond ``WIDE`` are computed in Python's whole numbers.

Defined results: rows that are null, of another length, or hold null or non-finite components are
left out, as are those with a component that overflows a double when scaled. Repeated rows count
each. Rows without an id are clustered, but start no centroid before any row with one; rows with
equal ids start in the order of their vectors. With fewer rows than ``clusters`` there are so many
centroids; with none there are no rows. A distance, or a sum of them, beyond the range of a long
is null. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import in_small_batches, prepare, stored

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
LENGTH = 64
BLOCK_ROWS = 8192
WIDE = 1 << 26  # below it a squared distance of up to 512 dimensions fits a long
LIMB = 32
LARGEST = (1 << 63) - 1


def whole_vectors(
    vectors: DataFrame, id_col: str, vector: str, length: int, scale: int
) -> DataFrame:
    """vec_id and vector (whole numbers as doubles) of the rows that take part."""
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(scale)))
    rows = vectors.where(F.size(vector) == length).select(
        F.col(id_col).cast("long").alias("vec_id"), scaled.alias("vector")
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return rows.where(finite)


def whole_numbers(doubles: np.ndarray) -> np.ndarray:
    """The floors of doubles; Python's whole numbers if some are large."""
    floors = np.floor(doubles)
    if len(floors) and np.abs(floors).max() >= WIDE:
        return np.array([[int(x) for x in row] for row in floors], dtype=object)
    return floors.astype(np.int64)


class Tables:
    """Squared differences from all centroids of the values of each dimension in a block."""

    def __init__(self, block: np.ndarray, centroids: list[list[int]]):
        codes = np.empty(block.shape, dtype=np.int64)
        values, start = [], 0
        for at in range(block.shape[1]):
            column = block[:, at]
            low, high = column.min(), column.max()
            if high - low < 4 * len(column) + 64:
                known = np.arange(high - low + 1).astype(block.dtype) + low
                codes[:, at] = (column - low).astype(np.int64) + start
            else:
                known, inverse = np.unique(column, return_inverse=True)
                codes[:, at] = inverse.reshape(-1) + start
            values.append(known)
            start += len(known)
        self.codes = codes
        wide = any(abs(c) >= WIDE for centroid in centroids for c in centroid)
        kind = object if wide or block.dtype == object else np.int64
        self.squares = [
            np.concatenate(
                [(v.astype(kind) - c) ** 2 for v, c in zip(values, centroid, strict=True)]
            )
            for centroid in centroids
        ]

    def nearest(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, the smallest of equal ones; distance."""
        best = distances = None
        for number, squares in enumerate(self.squares):
            far = squares[self.codes].sum(axis=1)
            if best is None:
                best, distances = np.zeros(len(far), dtype=np.int64), far
                continue
            closer = (far < distances).astype(bool)
            best[closer], distances[closer] = number, far[closer]
        return best, distances


def blocks(
    batches: Iterator[pa.RecordBatch], length: int, at_once: int
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole numbers of up to so many rows at a time."""

    def done() -> tuple[pa.Array, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        flat = table.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return table.column(0).combine_chunks(), whole_numbers(flat.reshape(-1, length))

    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= at_once:
            yield done()
            held, rows = [], 0
    if held:
        yield done()


def limbs(total: int) -> list[int]:
    """The number in signed digits of 32 bits, the lowest first."""
    sign, total = (-1, -total) if total < 0 else (1, total)
    digits = []
    while total or not digits:
        digits.append(sign * (total & ((1 << LIMB) - 1)))
        total >>= LIMB
    return digits


def moved(rows: DataFrame, centroids: list[list[int]], at_once: int) -> list[list[int]]:
    """The next centroids: floors of the means; those of empty clusters stay."""
    length = len(centroids[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [0] * len(centroids)
        totals = [[0] * length for _ in centroids]
        for _, block in blocks(batches, length, at_once):
            best, _ = Tables(block, centroids).nearest()
            for number in np.unique(best).tolist():
                members = block[best == number]
                counts[number] += len(members)
                for at, more in enumerate(members.sum(axis=0)):
                    totals[number][at] += int(more)
        found = []
        for number, count in enumerate(counts):
            if count:
                found.append((number, -1, 0, count))
                for at, total in enumerate(totals[number]):
                    found += [(number, at, limb, d) for limb, d in enumerate(limbs(total))]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["cluster", "at", "limb", "part"]
        )

    # As many rows as clusters, dimensions and limbs, whatever the input.
    added = (
        rows.mapInArrow(in_small_batches(sums), "cluster long, at long, limb long, part long")
        .groupBy("cluster", "at", "limb")
        .agg(F.sum("part").alias("part"))
        .collect()
    )
    totals: dict[tuple[int, int], int] = {}
    for row in added:
        key = (row["cluster"], row["at"])
        totals[key] = totals.get(key, 0) + (row["part"] << (LIMB * row["limb"]))
    return [
        [totals[number, at] // totals[number, -1] for at in range(length)]
        if (number, -1) in totals
        else centroid
        for number, centroid in enumerate(centroids)
    ]


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    named = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    chosen = (
        rows.withColumn("turn", F.sha2(named, 256))
        .orderBy(F.asc_nulls_last("turn"), "vector")
        .limit(clusters)
        .collect()
    )
    return [[int(np.floor(x)) for x in row["vector"]] for row in chosen]


def assigned(rows: DataFrame, centroids: list[list[int]], at_once: int) -> DataFrame:
    """vec_id, cluster and distance of every row."""
    length = len(centroids[0])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in blocks(batches, length, at_once):
            best, far = Tables(block, centroids).nearest()
            if far.dtype == object:
                far = [x if x <= LARGEST else None for x in far]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(best, pa.int32()), pa.array(far, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return rows.mapInArrow(in_small_batches(nearest), "vec_id long, cluster int, distance long")


def summed(far: str) -> Column:
    """The exact sum as a long; null if it does not fit or a distance did not."""
    total = F.sum(F.col(far).cast("decimal(38,0)"))
    return F.when(F.count(far) == F.count("*"), total.try_cast("long"))


def centroid_clusters(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    length: int = LENGTH,
    seed: int = 3,
    id_col: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every row that
    takes part."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(whole_vectors(vectors, id_col, vector, length, scale), "whole")
    centroids = first_centroids(rows, clusters, seed)
    if not centroids:
        schema = (
            "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
            "centroid_sha256 string"
        )
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = moved(rows, centroids, block_rows)
    result = stored(assigned(rows, centroids, block_rows), "assigned")
    # One row for each centroid.
    inertia = {
        row["cluster"]: row["inertia"]
        for row in result.groupBy("cluster").agg(summed("distance").alias("inertia")).collect()
    }
    over_all = result.agg(summed("distance").alias("inertia")).first()["inertia"]
    digests = [
        hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids
    ]

    def of_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster"))

    return result.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([inertia.get(k) for k in range(len(centroids))], "long").alias(
            "cluster_inertia"
        ),
        F.lit(over_all).cast("long").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )
