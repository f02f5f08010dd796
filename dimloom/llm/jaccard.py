"""Exact Jaccard join of shingle sets in their metric space, in regions that get ever smaller.

The Jaccard distance is a metric, so for a pivot p two sets within t of each other have distances
to p that differ by at most t. Documents that share nothing are all at distance 1 from each other
and from every pivot that is a document, so such pivots cannot part a corpus. The first pivots are
therefore the single shingles: a set is at distance 1 - 1/n from each one it holds, and 1 from
all others. Of these equal ones a global order says which come first, and t says to how many
regions a set has to go so that no linked pair is missed. The join goes down in steps:

1. *Lowest hashes.* A set goes to the regions of its ``n - ceil(0.8 n) + l`` lowest shingles, with
   l a tenth of n. Linked sets meet in l of them, counted on the smaller; sets that meet others in
   too few regions are dropped, twice over.
2. *Rarest first.* The whole sets of what is left go to the regions of all their shingles. Sets
   that share fewer than ceil(0.8 n) of them with others are dropped, twice over. Shingles that
   only one of the rest holds are in no intersection: without them, sets of one size that are
   equal form a class, whose sets have the same links outside it, and inside it all or none. One
   set stands for a class from here on. The rarest shingles suffice, as many as may miss one shared
   by a linked pair, plus one. Sets that meet in a region are of one family.
3. *Documents as pivots.* Inside a family distances vary. A large family is cut into Voronoi cells
   around pivots, bands of distance and hash parts; two parts are joined if their windows of
   distance to all pivots come within t of each other. Parts and small families are joined in
   one task each, exactly: by a matrix product where sets share much, or by their rarest shingles
   and by windows of size where they share little, whichever is expected to cost less.

Equal sets are one node throughout, so copies cost nothing after the first scan, and classes make
a template with one changed word per document a single row. A task never holds more than two
parts, each of ``REGION`` shingles and ``PART_SETS`` sets, and links are counted, not written as
pairs: what leaves a region is an edge to its component and the number of links of each set.

A shingle that very many sets hold is no region of one task. A bounded sample tells which those
are; they are held by two sets for certain, so their rows are dealt by set as well, and their
counts and least sets are put together from the parts.

Sets are identified by 64-bit hashes, as are shingles; a false match of sets is expected once in
about 10^19 / (number of sets)^2 / 2 corpora.

Defined results: words are runs of bytes other than the blank and the control characters 9 to 13,
with A-Z lowered; a text of one to four words has its whole sequence as one shingle; texts without
words have empty sets, linked with nothing, and are components of their own. A component's id is
its smallest doc_id that is not null. Repeated rows are copies of each other, and of one component
``one_of_each_group`` keeps the row with the smallest id, of equal ids the one with the smallest
hash of its text. An empty table gives no rows; texts of any length are read whole. Further
columns, whatever their names, are kept by ``one_of_each_group`` and otherwise not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.llm.common import (
    in_small_batches,
    join_hot,
    prepare,
    small_enough,
    stored,
    whole,
)
from dimloom.llm.graph import components
from dimloom.llm.words import class_table, mixed, word_hashes

_STEPS = 1 << 40
WORDS = 5
DISTANCE = 0.2
LINKABLE = 4  # shingles; a smaller set is linked to equal ones only
REGION = 2_000_000  # shingles of one part, 16 MB
PART_SETS = 16_384  # sets of one part
PIVOTS = 12  # of a large family
MEMORY = 500_000  # sets a task remembers to pass over copies
SAMPLE = 1 << 20  # shingles sampled to find the frequent ones
FREQUENT = 32  # sets of the sample that hold one
ROWS_AT_ONCE = 512  # of a matrix product
CELLS = 1 << 24  # of a matrix

CLASSES = class_table(bytes([9, 10, 11, 12, 13, 32]))
_FACTORS = np.array(
    [
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x27D4EB2F165667C5,
        0x85EBCA77C2B2AE63,
    ],
    dtype=np.uint64,
)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, first = word_hashes(texts, CLASSES)
    count = len(hashes) - WORDS + 1
    rolled = np.zeros(max(count, 0), dtype=np.uint64)
    for place, factor in enumerate(_FACTORS):
        if count > 0:
            rolled += hashes[place : place + count] * factor
    rolled = mixed(rolled)
    sets = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        words = end - begin
        if words >= WORDS:
            sets.append(np.unique(rolled[begin : end - WORDS + 1]))
        elif words:
            one = (hashes[begin:end] * _FACTORS[:words]).sum(dtype=np.uint64) + np.uint64(words)
            sets.append(mixed(np.array([one], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def at_least(n):
    """ceil(0.8 n), which a linked set of n shingles shares."""
    return (4 * n + 4) // 5


def slack(n):
    """The l of step 1."""
    return max(1, n // 10)


def set_id(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


class Seen:
    """Remembers a bounded number of sets; forgetting one only repeats work."""

    def __init__(self):
        self.known: set[int] = set()

    def new(self, node: int) -> bool:
        if node in self.known:
            return False
        if len(self.known) >= MEMORY:
            self.known.clear()
        self.known.add(node)
        return True


def lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def scan_lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, id and the lowest shingles of each text's set; none for a set met before."""
    seen = Seen()
    for batch in batches:
        sets = shingle_sets(batch.column(2).cast(pa.binary()).to_pylist())
        nodes = [set_id(s) for s in sets]
        lowest = []
        for node, shingles in zip(nodes, sets, strict=True):
            n = len(shingles)
            wanted = n - at_least(n) + slack(n) if n >= LINKABLE and seen.new(node) else 0
            lowest.append(shingles[:wanted])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(nodes, pa.int64()),
                lists(lowest),
            ],
            names=["doc_id", "text_hash", "n", "node", "keys"],
        )


def scan_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole sets of the texts, each once."""
    seen = Seen()
    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        found = [(set_id(s), s) for s in shingle_sets(texts)]
        found = [(node, shingles) for node, shingles in found if seen.new(node)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([node for node, _ in found], pa.int64()),
                pa.array([len(s) for _, s in found], pa.int64()),
                lists([s for _, s in found]),
            ],
            names=["node", "n", "keys"],
        )


def needed(n: Column) -> Column:
    """ceil(0.8 n) as a column."""
    return F.floor((4 * n + 4) / 5)


def frequent(sets: DataFrame) -> DataFrame:
    """key, often and parts of the shingles that very many of the sets (node, keys) hold.

    There are at most SAMPLE / FREQUENT of them. A part has about FREQUENT rows of the sample.
    """
    total = sets.agg(F.sum(F.size("keys"))).first()[0] or 0
    share = SAMPLE * _STEPS // max(total, SAMPLE)
    picked = sets.where(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(_STEPS)) < share)
    counts = (
        picked.where(F.size("keys") > 0)
        .dropDuplicates(["node"])
        .select(F.explode("keys").alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("often"))
        .where(F.col("often") >= FREQUENT)
    )
    return stored(counts.withColumn("parts", F.ceil(F.col("often") / FREQUENT)), "frequent")


def shingle_rows(sets: DataFrame, often: DataFrame, with_often: bool = False) -> DataFrame:
    """Rows (key, part, node, n); the part is 0 for shingles that are not frequent. ``with_often``
    adds how many sets of the sample hold a frequent one."""
    rows = sets.select("node", "n", F.explode("keys").alias("key"))
    part = 1 + F.pmod(F.xxhash64("node", F.lit(4)), F.col("parts"))
    return rows.join(F.broadcast(often), "key", "left").select(
        "key",
        F.coalesce(part, F.lit(0)).cast("int").alias("part"),
        "node",
        "n",
        *(["often"] if with_often else []),
    )


def met(rows: DataFrame) -> DataFrame:
    """Rows whose key occurs with another node too, each once."""
    same = Window.partitionBy("key", "part")
    spread = rows.withColumns({"_a": F.min("node").over(same), "_b": F.max("node").over(same)})
    shared = (F.col("_a") != F.col("_b")) | (F.col("part") > 0)
    return spread.where(shared).drop("_a", "_b").dropDuplicates(["key", "part", "node"])


def met_often(rows: DataFrame, least: Column) -> DataFrame:
    """Rows of the nodes that meet others in so many regions."""
    return (
        rows.withColumn("_met", F.count("*").over(Window.partitionBy("node")))
        .where(F.col("_met") >= least)
        .drop("_met")
    )


def narrowed(rows: DataFrame, least: Column) -> DataFrame:
    for _ in range(2):
        rows = met_often(met(rows), least)
    return rows


def shared_parts(sets: DataFrame) -> DataFrame:
    """node, n and keys of the sets that may be linked: the shingles that others hold too."""
    enough = needed(F.col("n"))
    left = met(met_often(met(shingle_rows(sets, frequent(sets))), enough))
    return (
        left.groupBy("node")
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list("key")).alias("keys"))
        .where(F.size("keys") >= enough)
    )


def families(sets: DataFrame) -> DataFrame:
    """node and component of the sets (node, n, keys) that may be linked to another (step 2)."""
    left = shingle_rows(sets, frequent(sets), with_often=True)
    same, by_node = Window.partitionBy("key", "part"), Window.partitionBy("node")
    # The order has to be one for all sets, so a frequent shingle counts as in the sample.
    held = F.coalesce(F.col("often") + (1 << 40), F.count("*").over(same))
    ranked = left.withColumn("held", held).withColumns(
        {
            "shared": F.count("*").over(by_node),
            "rank": F.row_number().over(by_node.orderBy("held", "key")),
        }
    )
    rarest = ranked.where(F.col("rank") <= F.col("shared") - needed(F.col("n")) + 1)
    met_in = rarest.withColumn("least", F.min("node").over(same))
    edges = met_in.select(F.col("node").alias("a"), F.col("least").alias("b"))
    # The least sets of the parts of a frequent shingle meet in it as well.
    parts = met_in.where("often is not null").groupBy("key", "part").agg(F.min("least").alias("a"))
    parts = stored(parts, "parts")
    whole_keys = parts.groupBy("key").agg(F.min("a").alias("b"))
    return components(edges.unionByName(parts.join(whole_keys, "key").select("a", "b")))


def distances(own: np.ndarray, size: int, pivots: list[tuple[np.ndarray, int]]) -> list[float]:
    """Jaccard distance of a set to every pivot, each with the size of the whole set."""
    far = []
    for pivot, other in pivots:
        at = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
        both = int((pivot[at] == own).sum())
        far.append(1 - both / (size + other - both))
    return far


class Region:
    """Sets of one or two parts, joined exactly.

    ``sizes`` are those of the whole sets; ``sets`` has at least the shingles that occur in others
    as well. Of a region of two parts (roles), only pairs of different parts are compared.
    """

    def __init__(self, nodes, sets, sizes, copies, roles):
        order = np.lexsort((nodes, sizes, roles))
        self.nodes, self.sizes, self.copies = nodes[order], sizes[order], copies[order]
        self.sets = [sets[i] for i in order]
        self.second = int(np.searchsorted(roles[order], roles.max()))  # 0 if there is one part
        lengths = np.array([len(s) for s in self.sets])
        _, codes, often = np.unique(
            np.concatenate(self.sets), return_inverse=True, return_counts=True
        )
        owners = np.repeat(np.arange(len(self.sets)), lengths)
        kept = often[codes] > 1
        _, self.codes = np.unique(codes[kept], return_inverse=True)
        self.owners = owners[kept]
        self.label = np.arange(len(self.sets))
        self.links = np.zeros(len(self.sets), dtype=np.int64)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes, the least node each is connected to, and its number of linked copies."""
        if len(self.codes):
            columns, weights = self.columns()
            count = len(self.sets)
            dense = count * count * (len(weights) / 2e10 + 4e-9)
            postings = np.bincount(self.codes).astype(float)
            pairs = min((postings**2).sum(), float(count) ** 2)
            sparse = 1e-4 * count + pairs * (len(self.codes) / count * 4e-9 + 1e-8)
            if count * len(weights) <= CELLS and dense <= sparse:
                self.by_matrix(columns, weights)
            else:
                self.by_rarest()
        least = np.full(len(self.sets), np.iinfo(np.int64).max)
        np.minimum.at(least, self.label, self.nodes)
        return self.nodes, least[self.label], self.links

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        """A column for each shingle, the same for those that the same sets hold, and how many
        shingles a column stands for."""
        marks = mixed(np.arange(1, len(self.sets) + 1, dtype=np.uint64))
        order = np.argsort(self.codes, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(self.codes[order]) != 0])
        held_by = np.add.reduceat(marks[self.owners[order]], starts)
        _, columns, weights = np.unique(held_by, return_inverse=True, return_counts=True)
        return columns, weights

    def unite(self, one: int, others: np.ndarray) -> None:
        labels = self.label[others]
        if (labels != self.label[one]).any():
            joined = np.unique(np.r_[labels, self.label[one]])
            self.label[np.isin(self.label, joined)] = joined[0]

    def by_matrix(self, columns: np.ndarray, weights: np.ndarray) -> None:
        """Intersections as products of membership matrices."""
        count = len(self.sets)
        held = np.zeros((count, len(weights)), dtype=np.float32)
        held[self.owners, columns[self.codes]] = 1
        # 9 |a and b| >= 4 (|a| + |b|) is a similarity of 0.8.
        sizes = self.sizes.astype(np.int64)
        for at in range(0, self.second or count, ROWS_AT_ONCE):
            rows = np.arange(at, min(at + ROWS_AT_ONCE, self.second or count))
            first = self.second or at
            both = (held[rows] * weights.astype(np.float32)) @ held[first:].T
            wanted = -(-4 * (sizes[rows, None] + sizes[None, first:]) // 9)
            linked = both >= wanted
            if not self.second:  # each pair once
                linked &= np.arange(first, count) > rows[:, None]
            self.links[rows] += linked @ self.copies[first:]
            self.links[first:] += linked.T @ self.copies[rows]
            for row in np.flatnonzero(linked.any(axis=1)).tolist():
                self.unite(int(rows[row]), first + np.flatnonzero(linked[row]))

    def by_rarest(self) -> None:
        """Candidates share one of their rarest shingles and are close in size."""
        count = len(self.sets)
        often = np.bincount(self.codes)
        order = np.lexsort((self.codes, often[self.codes], self.owners))
        owners, codes = self.owners[order], self.codes[order]
        starts = np.searchsorted(owners, np.arange(count + 1))
        shared = np.diff(starts)
        prefix = np.maximum(shared - at_least(self.sizes) + 1, 0)
        rare = np.arange(len(codes)) - starts[owners] < prefix[owners]
        by_code = np.argsort(codes[rare], kind="stable")
        holders = owners[rare][by_code]
        posting = np.searchsorted(codes[rare][by_code], np.arange(len(often) + 1))
        marks = np.zeros(len(often), dtype=bool)
        for one in range(self.second or count):
            own = codes[starts[one] : starts[one + 1]]
            found = [holders[posting[c] : posting[c + 1]] for c in own[: prefix[one]].tolist()]
            if not found:
                continue
            others = np.unique(np.concatenate(found))
            others = others[others >= self.second] if self.second else others[others > one]
            size, sizes = self.sizes[one], self.sizes[others]
            others = others[(4 * size <= 5 * sizes) & (4 * sizes <= 5 * size)]
            if not len(others):
                continue
            marks[own] = True
            lengths = shared[others]
            ends = np.cumsum(lengths)
            at = np.repeat(starts[others] - (ends - lengths), lengths) + np.arange(ends[-1])
            both = np.add.reduceat(marks[codes[at]].astype(np.int64), ends - lengths)
            marks[own] = False
            linked = others[9 * both >= 4 * (size + self.sizes[others])]
            if len(linked):
                self.links[one] += self.copies[linked].sum()
                self.links[linked] += self.copies[one]
                self.unite(one, linked)


def join_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (region, role, node, n, copies, keys) in the order of regions; joins each region."""

    def done() -> pa.RecordBatch:
        roles, nodes, sizes, copies = (
            np.array([m[i] for m in members], dtype=np.int64) for i in range(4)
        )
        joined = Region(nodes, [m[4] for m in members], sizes, copies, roles).joined()
        return pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in joined], names=["node", "least", "links"]
        )

    region, members, known = None, [], set()
    for batch in batches:
        keys = batch.column(5)
        values, offsets = keys.values.to_numpy().view(np.uint64), keys.offsets.to_numpy()
        for i, (at, *row) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)
        ):
            if at != region:
                if len(members) > 1:
                    yield done()
                region, members, known = at, [], set()
            if row[1] not in known:
                known.add(row[1])
                members.append((*row, values[offsets[i] : offsets[i + 1]].copy()))
    if len(members) > 1:
        yield done()


def parts_of_large(members: DataFrame) -> DataFrame:
    """Members (family, node, n, copies, keys) of large families, once for each pair of parts
    that has to be joined, with the pair as region and their side as role (step 3)."""
    by_hash = Window.partitionBy("family").orderBy(F.xxhash64("node"), "node")
    pivots = (
        members.withColumn("_turn", F.row_number().over(by_hash))
        .where(F.col("_turn") <= PIVOTS)
        .groupBy("family")
        .agg(F.sort_array(F.collect_list(F.struct("node", "n", "keys"))).alias("pivots"))
        .select("family", "pivots.keys", "pivots.n")
        .toDF("family", "pivots", "pivot_sizes")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            sizes = batch.column(2).to_pylist(), batch.column(7).to_pylist()
            for keys, some, n, others in zip(batch.column(5), batch.column(6), *sizes, strict=True):
                each = [p.values.to_numpy().view(np.uint64) for p in some]
                own = keys.values.to_numpy().view(np.uint64)
                found.append(distances(own, n, list(zip(each, others, strict=True))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(found, pa.list_(pa.float64()))],
                names=[*batch.schema.names[:6], "far"],
            )

    wide = members.join(pivots, "family").select(
        "family", "node", "n", "copies", F.lit(0).alias("role"), "keys", "pivots", "pivot_sizes"
    )
    placed = stored(
        wide.mapInArrow(
            in_small_batches(measure),
            "family long, node long, n long, copies long, role int, keys array<long>, "
            "far array<double>",
        )
        .withColumn("cell", F.array_position("far", F.array_min("far")))
        .withColumn("band", F.floor(F.array_min("far") / 0.1)),
        "cells",
    )
    cell = ["family", "cell", "band"]
    sizes = placed.groupBy(cell).agg(F.ceil(F.sum(weight()) / REGION).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts"))
    parted = placed.join(sizes, cell).withColumn(
        "part", F.struct("cell", "band", part.alias("nth"))
    )
    windows = (
        parted.select("family", "part", F.posexplode("far").alias("pivot", "far"))
        .groupBy("family", "part", "pivot")
        .agg(F.min("far").alias("low"), F.max("far").alias("high"))
        .groupBy("family", "part")
        .agg(F.sort_array(F.collect_list(F.struct("pivot", "low", "high"))).alias("windows"))
    )
    one = windows.select("family", F.col("part").alias("part_a"), F.col("windows").alias("wa"))
    two = windows.select("family", F.col("part").alias("part_b"), F.col("windows").alias("wb"))

    def gap(a: Column, b: Column) -> Column:
        return F.greatest(a["low"], b["low"]) - F.least(a["high"], b["high"])

    near = F.forall(F.zip_with("wa", "wb", gap), lambda apart: apart <= DISTANCE + 1e-9)
    pairs = one.join(two, "family").where((F.col("part_a") <= F.col("part_b")) & near)
    pairs = pairs.select(
        "family", F.xxhash64("family", "part_a", "part_b").alias("region"), "part_a", "part_b"
    )
    same = F.col("part_a") == F.col("part_b")
    sides = pairs.select(
        "family", "region", F.lit(0).alias("role"), F.col("part_a").alias("part")
    ).unionByName(
        pairs.where(~same).select(
            "family", "region", F.lit(1).alias("role"), F.col("part_b").alias("part")
        )
    )
    return parted.drop("role").join(sides, ["family", "part"]).select(
        "region", "role", "node", "n", "copies", "keys"
    )


def weight() -> Column:
    """What a set takes of a region's room."""
    return F.greatest(F.size("keys"), F.lit(REGION / PART_SETS))


def linked_classes(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of sets (node, n, keys, copies), one for each class: edges (a, b) between linked ones, and
    node with its number of linked copies."""
    family = families(classes).withColumnRenamed("component", "family")
    members = stored(classes.join(family, "node"), "members")
    weights = members.groupBy("family").agg(F.sum(weight()).alias("weight"))
    large = stored(weights.where(F.col("weight") > REGION).select("family"), "large")
    small = members.join(large, "family", "left_anti").select(
        F.col("family").alias("region"), F.lit(0).alias("role"), "node", "n", "copies", "keys"
    )
    regions = small
    if not large.isEmpty():
        regions = small.unionByName(parts_of_large(members.join(large, "family")))
    joined = stored(
        regions.repartition("region")
        .sortWithinPartitions("region", "role")
        .mapInArrow(in_small_batches(join_stream), "node long, least long, links long"),
        "joined",
    )
    apart = joined.where("node <> least")
    edges = apart.select(F.col("node").alias("a"), F.col("least").alias("b"))
    links = joined.groupBy("node").agg(F.sum("links").alias("links")).where("links > 0")
    return edges, links


def linked_sets(sets: DataFrame, copies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, component) of the linked sets, and (node, links) of those with links."""
    reduced = stored(
        shared_parts(sets)
        .join(copies, "node")
        .withColumn("class", F.xxhash64("n", "keys")),
        "reduced",
    )
    # Two sets of a class share its shingles and nothing else.
    inside = (9 * F.size("keys") >= 8 * F.col("n")) & (F.col("sets") > 1)
    classes = stored(
        reduced.groupBy("class")
        .agg(
            F.min("node").alias("node"),
            F.first("n").alias("n"),
            F.first("keys").alias("keys"),
            F.sum("copies").alias("copies"),
            F.count("*").alias("sets"),
        )
        .withColumn("inside", inside),
        "classes",
    )
    edges, outside = linked_classes(classes.select("node", "n", "keys", "copies"))
    told = stored(
        classes.select("class", F.col("node").alias("first"), "copies", "sets", "inside")
        .join(outside.withColumnRenamed("node", "first"), "first", "left")
        .where("inside or links is not null")
        .withColumnRenamed("copies", "class_copies"),
        "told",
    )
    members = reduced.select("node", "class", "copies")
    linked = stored(
        join_hot(members, told, ["class"], F.col("sets"), members.count(), "inner").select(
            "node",
            "first",
            (
                F.coalesce("links", F.lit(0))
                + F.when(F.col("inside"), F.col("class_copies") - F.col("copies")).otherwise(0)
            ).alias("links"),
        ),
        "linked",
    )
    to_first = linked.select(F.col("node").alias("a"), F.col("first").alias("b"))
    return components(edges.unionByName(to_first)), linked.select("node", "links")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n, component, component_id and n_links of every row.

    ``component`` is null for texts without words. ``text_hash`` is Spark's xxhash64 of the text.
    """
    prepare(docs.sparkSession)
    hashed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(whole(text)).alias("text_hash"),
        whole(text).alias("text"),
    )
    documents = stored(
        hashed.mapInArrow(
            in_small_batches(scan_lowest), "doc_id long, text_hash long, n long, node long, keys array<long>"
        ),
        "documents",
    )
    fewest = F.greatest(F.lit(1), F.floor(needed(F.col("n")) / 10))
    lowest = shingle_rows(documents, frequent(documents))
    left = narrowed(lowest, fewest).select("node").distinct()
    # One text stands for all with the same set.
    chosen = stored(
        documents.join(left, "node", "left_semi")
        .groupBy("node")
        .agg(F.min("text_hash").alias("text_hash"))
        .select("text_hash")
        .distinct(),
        "chosen",
    )
    texts = hashed.join(
        F.broadcast(chosen) if small_enough(chosen, 64) else chosen, "text_hash", "left_semi"
    )
    sets = stored(
        texts.select("text").mapInArrow(
            in_small_batches(scan_whole), "node long, n long, keys array<long>"
        ),
        "sets",
    )
    counted = (
        documents.where("n > 0")
        .groupBy("node")
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_id"))
    )
    component, links = linked_sets(sets, counted.select("node", "copies"))
    known = stored(
        counted.join(component, "node", "left")
        .join(links, "node", "left")
        .select(
            "node",
            "least_id",
            F.coalesce("component", "node").alias("component"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "known",
    )
    ids = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    result = known.join(ids, "component").select("node", "component", "component_id", "n_links")
    rows = documents.select("doc_id", "text_hash", "n", "node")
    without = rows.where("n = 0").select(
        "doc_id",
        "text_hash",
        "n",
        F.lit(None).cast("long").alias("component"),
        F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return rows.where("n > 0").join(result, "node").drop("node").unionByName(without)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row."""
    return jaccard_groups(docs, id_col, text).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all columns: one of each component, and all without words.

    The row with the smallest id stays. Rows are found again by id and text; of rows equal in
    both one stays, whatever their other columns.
    """
    groups = stored(jaccard_groups(docs, id_col, text), "groups")
    key = ["doc_id", "text_hash"]
    kept = (
        groups.where("component is not null")
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), *key)).alias("row"))
        .select("row.doc_id", "row.text_hash")
    )
    times = groups.groupBy(key).agg(F.count("*").alias("times"))
    named = F.col("doc_id").eqNullSafe(F.col("kept_id"))
    kept = stored(
        kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
        .join(times, named & (F.col("kept_hash") == F.col("text_hash")))
        .select("kept_id", "kept_hash", "times")
        .unionByName(
            groups.where("component is null")
            .select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
            .distinct()
            .withColumn("times", F.lit(1).cast("long"))
        ),
        "kept",
    )
    whole_rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(whole(text)).alias("text_hash"),
    )

    def found(some: DataFrame) -> DataFrame:
        some = F.broadcast(some) if small_enough(some, 128) else some
        return whole_rows.join(
            some, named & (F.col("text_hash") == F.col("kept_hash")), "left_semi"
        )

    result = found(kept.where("times = 1"))
    repeated = kept.where("times > 1")
    if not repeated.isEmpty():
        result = result.unionByName(found(repeated).dropDuplicates(key))
    return result.select("row.*")
