"""Near duplicates among embeddings by a forest of random-projection trees.

A tree cuts the vectors at the median of their projection on a random direction, one direction a
level, and again, until a leaf holds at most ``LEAF``. Vectors within ``SPILL`` of the median, as a
share of all, go to both sides. Vectors are compared exactly within each leaf of each tree, what
reaches the cosine is linked, and links are united. Trees are grown in two levels: the upper cuts
come from a bounded sample of the rows, and put every row into cells of about ``CELL``; a task
holds one cell and cuts it further. Trees are added, ``TREES`` at a time and ``MOST_TREES`` at
most, until ``RECALL`` of the links of a sample of rows, found by comparing those with all, meet in
a leaf.

Equal vectors are one node. Links are counted, never written: each node knows all its leaves, so
a pair counts in the first leaf it shares; what leaves a leaf is each node's number of links and
an edge to the least node it is connected to.

A group of near copies may hold much of a table, in more links than a leaf could ever show. Around
the dense places of the sample there are balls of so small an angle that any two vectors in one
are linked. A node belongs to the first ball it lies in. Pairs within a ball are then counted by
its size alone. Any other node is, by its angle to the centre, linked to the whole ball, to none of
it, or in a shell where it is compared exactly with all of it, blocks of the ball by blocks of the
shell; so no pair with a node in a ball is missed. Trees hold the nodes outside.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components are linked with nothing and are components of their own. Repeated rows are
linked to each other, whatever their ids. Rows without an id are linked, but name no component:
their component's id is the smallest id in it, null if there is none. An empty table gives no
rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import in_small_batches, join_hot, prepare, stored
from dimloom.llm.graph import components

COSINE = 0.9
LEAF = 512
CELL = 8192
SPILL = 0.06
TREES = 8
MOST_TREES = 40
RECALL = 0.95
PROBES = 256
SAMPLE = 16_384
LEAST_SAMPLED = 8  # rows of the sample in a cell
DENSE = 16  # rows of a sample of BALL_SAMPLE in a ball
BALL_SAMPLE = 4096
BLOCK = 2048  # rows of a ball, or of its shell, compared at once
SEED = 41
_SLACK = 1e-9
_STEPS = 1 << 40


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, as doubles; scaled first, so no square overflows or vanishes."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def at_least(cosines: np.ndarray, one: np.ndarray, other: np.ndarray, least: float) -> np.ndarray:
    """Which products of unit vectors reach the cosine; close ones are summed again alone, as the
    last digits of a matrix product depend on its shape."""
    reached = cosines >= least
    close = np.nonzero(np.abs(cosines - least) < _SLACK)
    if len(close[0]):
        reached[close] = (one[close[0]] * other[close[1]]).sum(axis=1) >= least
    return reached


def vectors_of(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def direction(tree: int, level: int, length: int) -> np.ndarray:
    return np.random.default_rng([SEED, tree, level]).normal(size=length)


class UpperTree:
    """Cuts grown from a sample, down to leaves (cells) that stand for few enough rows."""

    def __init__(self, number: int, sample: np.ndarray, most: float):
        self.number = number
        # low, high, both children; a leaf has its cell and depth in place of the cuts
        self.nodes: list[tuple[float, float, int, int]] = []
        self.cells = 0
        self.levels = 0
        self._grow(sample, np.arange(len(sample)), 0, max(most, 2 * LEAST_SAMPLED))

    def _grow(self, sample: np.ndarray, rows: np.ndarray, level: int, most: float) -> int:
        place = len(self.nodes)
        self.nodes.append((self.cells, level, -1, -1))
        self.levels = max(self.levels, level)
        if len(rows) <= most:
            self.cells += 1
            return place
        far = sample[rows] @ direction(self.number, level, sample.shape[1])
        low, high = np.quantile(far, (0.5 - SPILL, 0.5 + SPILL)).tolist()
        sides = rows[far <= high], rows[far >= low]
        if max(map(len, sides)) == len(rows):
            self.cells += 1
            return place
        children = [self._grow(sample, side, level + 1, most) for side in sides]
        self.nodes[place] = (low, high, *children)
        return place

    def reached(self, units: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Cells and the rows in them."""
        length = units.shape[1]
        axes = [direction(self.number, level, length) for level in range(self.levels)]
        far = units @ np.array(axes).reshape(-1, length).T
        stack = [(0, np.arange(len(units)), 0)]
        while stack:
            node, rows, level = stack.pop()
            low, high, left, right = self.nodes[node]
            if not len(rows):
                continue
            if left < 0:
                yield int(low), rows
                continue
            here = far[rows, level]
            stack.append((left, rows[here <= high], level + 1))
            stack.append((right, rows[here >= low], level + 1))

    def depth(self, cell: int) -> int:
        return next(int(n[1]) for n in self.nodes if n[2] < 0 and n[0] == cell)


def leaves_below(units: np.ndarray, tree: int, level: int, most: int) -> Iterator[np.ndarray]:
    """Rows of each leaf of one cell, cut by rank."""
    stack = [(np.arange(len(units)), level)]
    while stack:
        rows, level = stack.pop()
        if len(rows) <= most:
            yield rows
            continue
        far = units[rows] @ direction(tree, level, units.shape[1])
        order = rows[np.argsort(far, kind="stable")]
        half, spilled = len(rows) / 2, SPILL * len(rows)
        stack.append((order[: int(np.ceil(half + spilled))], level + 1))
        stack.append((order[int(half - spilled) :], level + 1))


def grouped(
    batches: Iterator[pa.RecordBatch], done: Callable[[int, pa.Table], pa.RecordBatch | None]
) -> Iterator[pa.RecordBatch]:
    """Applies a function to the rows of each value of the first column, which come in order."""
    key, held = None, []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if begin == end:
                continue
            if held and keys[begin] != key:
                found = done(int(key), pa.Table.from_batches(held).combine_chunks())
                if found is not None:
                    yield found
                held = []
            key = keys[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        found = done(int(key), pa.Table.from_batches(held).combine_chunks())
        if found is not None:
            yield found


# A leaf's number: its tree, its cell and its place in it.
CELL_BITS, PLACE_BITS = 20, 30


def tree_leaves(nodes: DataFrame, trees: list[UpperTree], length: int, leaf: int) -> DataFrame:
    """node and leaf, one row for each leaf of each of the trees."""
    kind = nodes.schema["vector"].dataType.simpleString()

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit(vectors_of(batch.column(1), length))
            for tree in trees:
                for cell, rows in tree.reached(units):
                    there = batch.take(pa.array(rows))
                    number = (tree.number << CELL_BITS) + cell
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), number)), *there.columns],
                        names=["cell", "node", "vector"],
                    )

    def leaves(cell: int, rows: pa.Table) -> pa.RecordBatch:
        tree = by_number[cell >> CELL_BITS]
        depth = tree.depth(cell & ((1 << CELL_BITS) - 1))
        units = unit(vectors_of(rows.column(2).combine_chunks(), length))
        found = list(leaves_below(units, tree.number, depth, leaf))
        at = np.concatenate(found)
        places = np.repeat(np.arange(len(found)), [len(f) for f in found])
        return pa.RecordBatch.from_arrays(
            [
                rows.column(1).combine_chunks().take(pa.array(at)),
                pa.array((cell << PLACE_BITS) + places),
            ],
            names=["node", "leaf"],
        )

    by_number = {tree.number: tree for tree in trees}
    return (
        nodes.select("node", "vector")
        .mapInArrow(in_small_batches(cells), f"cell long, node long, vector {kind}")
        .repartition("cell")
        .sortWithinPartitions("cell", "node")
        .mapInArrow(lambda batches: grouped(batches, leaves), "node long, leaf long")
    )


def least_connected(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the first row it is connected to."""
    label = np.arange(len(links))
    while True:
        other = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, other)
        new = new[new]
        if (new == label).all():
            return label
        label = new


LINKS = "node long, least long, links long"


def links_batch(nodes, least, links) -> pa.RecordBatch:
    arrays = [pa.array(x, pa.int64()) for x in (nodes, least, links)]
    return pa.RecordBatch.from_arrays(arrays, names=["node", "least", "links"])


def leaf_links(leaf: int, rows: pa.Table, length: int) -> pa.RecordBatch | None:
    """Links within a leaf, from rows (leaf, node, copies, vector, leaves); those of pairs that
    share an earlier leaf connect, but do not count."""
    nodes, copies = (rows.column(i).to_numpy() for i in (1, 2))
    units = unit(vectors_of(rows.column(3).combine_chunks(), length))
    links = at_least(units @ units.T, units, units, COSINE)
    np.fill_diagonal(links, False)
    links |= links.T
    some = np.flatnonzero(links.any(axis=1))
    if not len(some):
        return None
    links, nodes, copies = links[np.ix_(some, some)], nodes[some], copies[some]
    order = np.argsort(nodes)
    links, nodes, copies, some = links[np.ix_(order, order)], nodes[order], copies[order], some[order]
    lists = rows.column(4).combine_chunks().take(pa.array(some))
    held = lists.flatten().to_numpy()
    owners = np.repeat(np.arange(len(some)), lists.value_lengths().to_numpy())
    earlier = held < leaf
    known, codes = np.unique(held[earlier], return_inverse=True)
    marks = np.zeros((len(some), len(known)), dtype=np.float32)
    marks[owners[earlier], codes] = 1
    marks = marks[:, marks.sum(axis=0) > 1]
    new = links & (marks @ marks.T == 0)
    return links_batch(nodes, nodes[least_connected(links)], new @ copies)


@dataclass(frozen=True)
class Balls:
    """Unit centres, and the angle of every ball."""

    centres: np.ndarray
    angles: np.ndarray

    def cosines(self, units: np.ndarray) -> np.ndarray:
        return np.clip(units @ self.centres.T, -1, 1)


# Two vectors within this angle of a centre are linked.
BALL_COSINE = float(np.cos(np.arccos(COSINE) / 2 - 1e-6))


def dense_centres(units: np.ndarray) -> np.ndarray:
    """Centres of the places where a sample is dense, the densest first."""
    near = (units @ units.T) >= BALL_COSINE
    centres = []
    while True:
        sizes = near.sum(axis=1)
        best = int(sizes.argmax()) if len(sizes) else 0
        if not len(sizes) or sizes[best] < DENSE:
            return np.array(centres).reshape(-1, units.shape[1])
        centre = units[near[best]].mean(axis=0)
        centre /= np.sqrt((centre**2).sum())
        centres.append(centre)
        gone = near[best] | (units @ centre >= BALL_COSINE)
        near[gone], near[:, gone] = False, False


def in_balls(nodes: DataFrame, centres: np.ndarray, length: int) -> tuple[DataFrame, Balls]:
    """nodes with ``ball`` (-1 outside), and the balls with the angles they come to."""
    balls = Balls(centres, np.zeros(len(centres)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("vector")
        for batch in batches:
            inside = balls.cosines(unit(vectors_of(batch.column(at), length)))
            first = np.where((inside >= BALL_COSINE).any(axis=1), (inside >= BALL_COSINE).argmax(1), -1)
            angle = np.arccos(inside[np.arange(len(first)), first])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first, pa.int64()), pa.array(angle)],
                names=[*names, "ball", "angle"],
            )

    names = nodes.columns
    kinds = ", ".join(f"{n} {t}" for n, t in nodes.dtypes)
    placed = stored(
        nodes.mapInArrow(in_small_batches(place), f"{kinds}, ball long, angle double"), "balls"
    )
    # At most one row for every DENSE rows of the sample.
    angles = np.zeros(len(centres))
    for row in placed.where("ball >= 0").groupBy("ball").agg(F.max("angle").alias("a")).collect():
        angles[row["ball"]] = row["a"]
    return placed, Balls(centres, angles)


def ball_links(placed: DataFrame, balls: Balls, length: int) -> DataFrame:
    """Links (node, least, links) of all pairs with a node in a ball. A pair of nodes of two balls
    belongs to the first of them."""
    members = placed.where("ball >= 0")
    # Again one row a ball.
    sizes = (
        members.groupBy("ball")
        .agg(
            F.sum("copies").alias("weight"), F.count("*").alias("there"), F.min("node").alias("first")
        )
        .collect()
    )
    by_ball = {r["ball"]: r for r in sizes}
    count = len(balls.centres)
    weights = np.array([by_ball[b]["weight"] if b in by_ball else 0 for b in range(count)])
    firsts = np.array([by_ball[b]["first"] if b in by_ball else -1 for b in range(count)])
    parts = [-(-by_ball[b]["there"] // BLOCK) if b in by_ball else 0 for b in range(count)]
    widest = np.arccos(COSINE)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (node, copies, relation, ball) for the balls a node is linked to (1) or may be (0)."""
        for batch in batches:
            node, copies, vector, own = (batch.column(i) for i in range(4))
            angles = np.arccos(balls.cosines(unit(vectors_of(vector, length))))
            ours = own.to_numpy()
            may = (np.arange(count) < np.where(ours < 0, count, ours)[:, None]) & (weights > 0)
            full = may & (angles + balls.angles <= widest - _SLACK)
            shell = may & ~full & (angles - balls.angles <= widest + _SLACK)
            for relation, pairs in ((1, full), (0, shell)):
                rows, ball = np.nonzero(pairs)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        node.take(at),
                        copies.take(at),
                        pa.array(np.full(len(rows), relation), pa.int32()),
                        pa.array(ball, pa.int64()),
                    ],
                    names=["node", "copies", "relation", "ball"],
                )

    def of_ball(values) -> Column:
        return F.get(F.array(*(F.lit(int(v)).cast("long") for v in values)), F.col("ball").cast("int"))

    related = stored(
        placed.select("node", "copies", "vector", "ball").mapInArrow(
            in_small_batches(around), "node long, copies long, relation int, ball long"
        ),
        "around",
    )
    full = related.where("relation = 1")
    outer = np.zeros(count, dtype=np.int64)
    for row in full.groupBy("ball").agg(F.sum("copies").alias("weight")).collect():
        outer[row["ball"]] = row["weight"]
    inside = members.select(
        "node",
        of_ball(firsts).alias("least"),
        (of_ball(weights + outer) - F.col("copies")).alias("links"),
    )
    whole = full.select("node", of_ball(firsts).alias("least"), of_ball(weights).alias("links"))

    shell = related.where("relation = 0").select("node", F.col("ball").alias("near_ball"))
    shells = shell.groupBy("near_ball").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    shells = {r["near_ball"]: r["blocks"] for r in shells.collect()}
    if not shells:
        return inside.unionByName(whole)
    blocks = [shells.get(b, 0) for b in range(count)]

    def dealt(salt: int, many: list[int]) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.greatest(of_ball(many), F.lit(1)))

    def every(many: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), of_ball(many) - 1))

    one = members.where(of_ball(blocks) > 0).select(
        "ball", dealt(1, parts).alias("part"), every(blocks).alias("block"),
        F.lit(0).alias("role"), "node", "copies", "vector",
    )
    other = (
        placed.drop("ball", "angle")
        .join(shell.withColumnRenamed("near_ball", "ball"), "node")
        .select(
            "ball", every(parts).alias("part"), dealt(2, blocks).alias("block"),
            F.lit(1).alias("role"), "node", "copies", "vector",
        )
    )

    def compare(region: int, rows: pa.Table) -> pa.RecordBatch | None:
        ball, role, node, copies = (rows.column(i).to_numpy() for i in (1, 2, 3, 4))
        units = unit(vectors_of(rows.column(5).combine_chunks(), length))
        ours, theirs = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        links = at_least(units[ours] @ units[theirs].T, units[ours], units[theirs], COSINE)
        first = np.full(len(node), firsts[ball[0]])
        counted = np.zeros(len(node), dtype=np.int64)
        counted[ours], counted[theirs] = links @ copies[theirs], links.T @ copies[ours]
        kept = counted > 0
        return links_batch(node[kept], first[kept], counted[kept]) if kept.any() else None

    regions = one.unionByName(other).select(
        F.xxhash64("ball", "part", "block").alias("region"), "ball", "role", "node", "copies", "vector"
    )
    compared = (
        regions.repartition("region")
        .sortWithinPartitions("region", "role", "node")
        .mapInArrow(lambda batches: grouped(batches, compare), LINKS)
    )
    return inside.unionByName(whole).unionByName(compared)


def share_met(forest: DataFrame, probes: np.ndarray, length: int) -> float:
    """Of the links of the probes (nodes) to all others, the share that meets in some leaf."""
    picked = forest.where(F.col("node").isin(probes.tolist())).orderBy("node").toArrow()
    nodes = picked.column("node").to_numpy()
    units = unit(vectors_of(picked.column("vector").combine_chunks(), length))
    lists = picked.column("leaves").combine_chunks()
    known, codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    marks = np.zeros((len(nodes), len(known)), dtype=np.float32)
    marks[np.repeat(np.arange(len(nodes)), lists.value_lengths().to_numpy()), codes] = 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = met = 0
        for batch in batches:
            own = unit(vectors_of(batch.column(1), length))
            links = at_least(own @ units.T, own, units, COSINE)
            links &= batch.column(0).to_numpy()[:, None] != nodes
            some = np.flatnonzero(links.any(axis=1))
            if not len(some):
                continue
            leaves = batch.column(2).take(pa.array(some))
            held = leaves.flatten().to_numpy()
            owners = np.repeat(np.arange(len(some)), leaves.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(known, held), len(known) - 1)
            same = known[at] == held
            ours = np.zeros((len(some), len(known)), dtype=np.float32)
            ours[owners[same], at[same]] = 1
            there += int(links.sum())
            met += int((links[some] & (ours @ marks.T > 0)).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([there], pa.int64()), pa.array([met], pa.int64())], names=["there", "met"]
        )

    total = (
        forest.select("node", "vector", "leaves")
        .mapInArrow(in_small_batches(count), "there long, met long")
        .agg(F.sum("there").alias("there"), F.sum("met").alias("met"))
        .first()
    )
    return total["met"] / total["there"] if total["there"] else 1.0


def forest_links(
    nodes: DataFrame, sample: np.ndarray, probes: np.ndarray, length: int, leaf: int
) -> DataFrame:
    """Links (node, least, links) that the leaves show among nodes (node, copies, vector)."""
    count = nodes.count()
    most = CELL * len(sample) / max(count, 1)
    found, forest, number = None, nodes, 0
    while True:
        trees = [UpperTree(number + i, sample, most) for i in range(TREES)]
        number += TREES
        more = stored(tree_leaves(nodes, trees, length, leaf), "leaves")
        found = more if found is None else found.unionByName(more)
        lists = found.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
        forest = stored(nodes.join(lists, "node"), "forest")
        if not len(probes) or number >= MOST_TREES or share_met(forest, probes, length) >= RECALL:
            break
    rows = forest.select(F.explode("leaves").alias("leaf"), "node", "copies", "vector", "leaves")
    return (
        rows.repartition("leaf")
        .sortWithinPartitions("leaf", "node")
        .mapInArrow(
            lambda batches: grouped(batches, lambda at, some: leaf_links(at, some, length)),
            LINKS,
        )
    )


def usable(vector: Column, length: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) == length) & finite & some, F.lit(False))


def alone(rows: DataFrame) -> DataFrame:
    """Results of rows that are linked with nothing."""
    return rows.select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", leaf: int = LEAF
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; ``leaf`` is the most a leaf holds."""
    prepare(vectors.sparkSession)
    hashes = [F.xxhash64("vector"), F.xxhash64(F.lit(SEED), "vector")]
    # Plus zero, so that minus zero is the same.
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(F.col(vector), lambda x: x + F.lit(0).cast("float")).alias("vector"),
    )
    lengths = rows.groupBy(F.size("vector").alias("length")).count().where("length > 0")
    most = lengths.orderBy(F.desc("count"), "length").first()
    if most is None:
        return alone(rows)
    length = most["length"]
    takes_part = usable(F.col("vector"), length)
    keyed = rows.where(takes_part).withColumns({"k1": hashes[0], "k2": hashes[1]})
    nodes = stored(
        keyed.groupBy("k1", "k2")
        .agg(
            F.first("vector").alias("vector"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least_id"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    total = nodes.agg(F.count("*").alias("nodes"), F.sum("copies").alias("rows")).first()
    if not total["nodes"]:
        return alone(rows)

    # A hash of the numbers picks, and a little more than wanted is cut off.
    share = min(_STEPS, (SAMPLE + SAMPLE // 8) * _STEPS // total["nodes"])
    turn = F.xxhash64("node", F.lit(2))
    picked = (
        nodes.where(F.pmod(turn, F.lit(_STEPS)) < share)
        .orderBy(turn, "node")
        .limit(SAMPLE)
        .select("node", "vector")
        .toArrow()
    )
    sampled = picked.column("node").to_numpy()
    sample = unit(vectors_of(picked.column("vector").combine_chunks(), length))
    centres = dense_centres(sample[:BALL_SAMPLE])
    base = nodes.select("node", "copies", "vector")
    found, outside = None, base
    if len(centres):
        placed, balls = in_balls(base, centres, length)
        found = ball_links(placed, balls, length)
        outside = placed.where("ball < 0").drop("ball", "angle")
        free = ~(sample @ centres.T >= BALL_COSINE).any(axis=1)
        sampled, sample = sampled[free], sample[free]
    if len(sampled):
        among = forest_links(outside, sample, sampled[:PROBES], length, leaf)
        found = among if found is None else found.unionByName(among)
    found = stored(found, "links")

    edges = found.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        nodes.drop("vector")
        .join(links, "node", "left")
        .join(components(edges), "node", "left")
        .select(
            "k1",
            "k2",
            "copies",
            "least_id",
            F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
        .where("n_links > 0")
    )
    known = stored(known, "known")
    ids = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    told = stored(known.join(ids, "component").drop("component", "least_id"), "told")
    keys = keyed.select("vec_id", "k1", "k2")
    return (
        join_hot(keys, told, ["k1", "k2"], F.col("copies"), total["rows"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.when(F.col("n_links") > 0, F.col("component_id"))
            .otherwise(F.col("vec_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
        .unionByName(alone(rows.where(~takes_part)))
    )

