"""Spelling variants: words that one edit turns into each other, found by k-d trees.

A word's vector counts its letters. One inserted, deleted or replaced letter raises one count by
one, lowers one, or both, so near words are at most two apart in L1 distance. For each length of
words there is a k-d tree over their vectors; a word looks in the trees of its own length and of
those one more and one less, and leaves out every box that it cannot reach by the one rise and the
one fall that the pair of lengths allows. What is left is compared by packed counts, then letter
by letter.

The trees are in two levels. The upper ones are grown from a sample of ``SAMPLE`` words on average
until a leaf stands for about ``CELL`` words; each leaf is a cell that one task searches. Every
word is an entry of one cell, and a query in each cell it may reach. A task grows the lower tree
over the entries of a cell and streams the queries past it. Anagrams have equal vectors, so a leaf
of them cannot be cut by counts: it is dealt out by the first and the last half of the letters,
one of which near words share.

Words of a text are counted in the task that reads it, in a bounded table, and added up by Spark.
What leaves a cell is one row for each query: how many near words it met, and the best. Forms are
followed to their roots by doubling steps; a form occurs at least twice as often as its word, so
chains are short and cannot close.

Defined results: null and empty texts have no words; in rows without an id no letter is deleted;
repeated rows count each; a word without near words has itself as root; an empty table gives no
rows. Ties of the largest count go to the smallest word. Texts of any length are read whole; words
of 64 letters and more share one tree. Other columns of the input are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import in_small_batches, prepare, stored

SHORTEST = 5
LEAST_TIMES = 3
FACTOR = 2  # a form occurs so many times as often as the word
ONE_IN = 97  # runs that lose a letter
LONG = 64  # words of this length and more share a tree
CELL = 20_000
SAMPLE = 20_000
LEAF = 32
TALLY = 200_000  # words counted in a task before they are handed on
QUERIES_AT_ONCE = 8192
PAIRS_AT_ONCE = 1 << 21
DIMENSIONS = 32  # a to z, and six for the other letters

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)
_DIMENSION = np.zeros(256, dtype=np.int64)
_DIMENSION[ord("a") : ord("z") + 1] = np.arange(26)
_DIMENSION[0xC0:] = 26 + np.arange(64) % 6


def tally(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Words of rows (doc_id, text) with their counts, each maybe more than once."""

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
            names=["word", "n"],
        )

    counts: Counter[str] = Counter()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            # Lowering bytes touches A-Z only.
            lowered = text.lower().decode("utf-8", "replace")
            runs = Counter(match.group() for match in _RUN.finditer(lowered))
            if doc_id is None:
                counts.update(runs)
                continue
            before = zlib.crc32(b"%d:" % doc_id)
            for run, times in runs.items():
                value = zlib.crc32(run.encode("utf-8"), before)
                if value % ONE_IN == 0:
                    at = value % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < SHORTEST:
                        continue
                counts[run] += times
            if len(counts) >= most:
                yield done()
                counts.clear()
    yield done()


def vocabulary(docs: DataFrame, id_col: str, text: str, most: int = TALLY) -> DataFrame:
    """word and n of the words that occur often enough."""
    picked = docs.where(F.col(text).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    counts = in_small_batches(lambda batches: tally(batches, most))
    words = picked.mapInArrow(counts, "word string, n long")
    counted = words.groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= LEAST_TIMES), "vocabulary")


class Words:
    """Words with what is compared: lengths, letter counts, packed counts and letters."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        owners = np.repeat(np.arange(len(words)), self.lengths)
        cells = owners * DIMENSIONS + _DIMENSION[flat]
        counts = np.bincount(cells, minlength=len(words) * DIMENSIONS)
        # A count that is cut still changes by at most one with an edit.
        self.counts = np.minimum(counts, 127).astype(np.int8).reshape(-1, DIMENSIONS)
        bits = np.concatenate([self.counts >= 1, self.counts >= 2], axis=1)
        self.packed = np.packbits(bits, axis=1).view(np.uint64).reshape(-1)
        places = np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        short = places < LONG
        self.letters = np.zeros((len(words), LONG + 1), dtype=np.uint8)
        self.letters[owners[short], places[short]] = flat[short]


def one_edit(a: str, b: str) -> bool:
    """If exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:  # letters they share at the start
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def near(one: Words, i: np.ndarray, other: Words, j: np.ndarray) -> np.ndarray:
    """For each pair of places, if the words are one edit apart."""
    lengths, others = one.lengths[i], other.lengths[j]
    found = np.zeros(len(i), dtype=bool)
    short = (lengths < LONG) & (others < LONG)
    same = np.flatnonzero(short & (lengths == others))
    found[same] = (one.letters[i[same]] != other.letters[j[same]]).sum(axis=1) == 1
    places = np.arange(LONG)
    for longer in (False, True):
        at = np.flatnonzero(short & (others - lengths == (1 if longer else -1)))
        less, more = one.letters[i[at]], other.letters[j[at]]
        if not longer:
            less, more = more, less
        shared = (less != more).argmax(axis=1)
        shifted = (less[:, :-1] != more[:, 1:]) & (places >= shared[:, None])
        found[at] = ~shifted.any(axis=1)
    for at in np.flatnonzero(~short).tolist():
        found[at] = one_edit(one.words[i[at]], other.words[j[at]])
    return found


class Tree:
    """A k-d tree over letter counts: cuts at medians until a leaf stands for few enough rows."""

    def __init__(self, counts: np.ndarray, most: int, weight: float = 1.0, least: int = 1):
        self.nodes: list[tuple[int, int, int, int]] = []  # dimension, threshold, both children
        self.leaf_rows: list[int] = []
        self._grow(counts, np.arange(len(counts)), most / weight, least)

    def _grow(self, counts: np.ndarray, rows: np.ndarray, most: float, least: int) -> int:
        number = len(self.nodes)
        self.nodes.append((-1, len(self.leaf_rows), 0, 0))
        if len(rows) > most and len(rows) >= 2 * least:
            here = counts[rows]
            medians = np.sort(here, axis=0)[(len(rows) - 1) // 2]
            below = (here <= medians).sum(axis=0)
            lower = (here < medians).sum(axis=0)
            # The more even of the cuts on either side of the median.
            use_lower = np.abs(2 * lower - len(rows)) < np.abs(2 * below - len(rows))
            left = np.where(use_lower, lower, below)
            at = int(np.argmin(np.abs(2 * left - len(rows))))
            if least <= left[at] <= len(rows) - least:
                threshold = int(medians[at]) - int(use_lower[at])
                goes = here[:, at] <= threshold
                children = [self._grow(counts, rows[side], most, least) for side in (goes, ~goes)]
                self.nodes[number] = (at, threshold, *children)
                return number
        self.nodes[number] = (-1, len(self.leaf_rows), 0, 0)
        self.leaf_rows.append(len(rows))
        return number

    def reached(
        self, counts: np.ndarray, rises: int, falls: int
    ) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, each with the rows that reach its box by so many counts raised and lowered
        by one; every row is at its own leaf for 0 and 0."""
        start = np.zeros(len(counts), dtype=np.int8)
        stack = [(0, np.arange(len(counts)), start, start, {}, {})]
        while stack:
            node, rows, up, down, low, high = stack.pop()
            if not len(rows):
                continue
            at, threshold, left, right = self.nodes[node]
            if at < 0:
                yield threshold, rows
                continue
            q = counts[rows, at].astype(np.int16)
            # A count outside the box so far has been paid for.
            fall = (q > threshold) & ~(q > high.get(at, 1 << 10))
            rise = (q <= threshold) & ~(q < low.get(at, -1))
            kept = (q <= threshold + 1) & (down + fall <= falls)
            stack.append(
                (left, rows[kept], up[kept], (down + fall)[kept], low, high | {at: threshold})
            )
            kept = (q >= threshold) & (up + rise <= rises)
            stack.append(
                (right, rows[kept], (up + rise)[kept], down[kept], low | {at: threshold + 1}, high)
            )


# Counts a word of one length may raise and lower to be a word of another.
REACH = {-1: (0, 1), 0: (1, 1), 1: (1, 0)}


class UpperTrees:
    """A tree for each length, and over how many parts each leaf is dealt."""

    def __init__(self, sizes: dict[int, int], sample: np.ndarray, lengths: np.ndarray):
        self.trees: dict[int, Tree] = {}
        self.first: dict[int, int] = {}  # number of a tree's first cell
        self.parts: dict[int, list[int]] = {}
        cells = 0
        for length, size in sorted(sizes.items()):
            some = sample[lengths == length]
            weight = size / max(len(some), 1)
            tree = Tree(some, CELL, weight, least=8)
            self.trees[length], self.first[length] = tree, cells
            self.parts[length] = [max(1, round(n * weight / CELL)) for n in tree.leaf_rows]
            cells += len(tree.leaf_rows)

    def cells(self, words: Words, length: int, reach: tuple[int, int], rows: np.ndarray):
        """Cells (as text: leaf, side, part) of a tree that rows reach, with those rows."""
        half = (length - 1) // 2
        for leaf, reached in self.trees[length].reached(words.counts[rows], *reach):
            reached, parts = rows[reached], self.parts[length][leaf]
            cell = f"{self.first[length] + leaf}"
            if parts == 1:
                yield cell, reached
                continue
            for row in reached.tolist():
                for side, part in enumerate(halves(words.words[row], half, parts)):
                    yield f"{cell}:{side}:{part}:{parts}:{half}", [row]


def halves(word: str, half: int, parts: int) -> tuple[int, int]:
    """Parts by the first and by the last letters."""
    return tuple(
        zlib.crc32(letters.encode("latin-1")) % parts for letters in (word[:half], word[-half:])
    )


ENTRY, QUERY = 0, 1


def dealt(trees: UpperTrees):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (cell, role, word, n) of the words, for every cell they go to."""
        for batch in gathered(batches):
            words, n = Words(batch.column(0).to_pylist()), batch.column(1).to_numpy()
            bucket = np.minimum(words.lengths, LONG)
            cells, roles, at = [], [], []
            for length in np.unique(bucket).tolist():
                rows = np.flatnonzero(bucket == length)
                ways = [(ENTRY, length, (0, 0))]
                ways += [(QUERY, length + step, reach) for step, reach in REACH.items()]
                for role, other, reach in ways:
                    if other not in trees.trees:
                        continue
                    for cell, reached in trees.cells(words, other, reach, rows):
                        cells += [cell] * len(reached)
                        roles += [role] * len(reached)
                        at.append(np.asarray(reached))
            at = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cells, pa.string()),
                    pa.array(roles, pa.int32()),
                    batch.column(0).take(pa.array(at)),
                    pa.array(n[at], pa.int64()),
                ],
                names=["cell", "role", "word", "n"],
            )

    return deal


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to some thousands of rows; words are short."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= QUERIES_AT_ONCE:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


class Cell:
    """The entries of a cell in the order of words, in a tree of their own."""

    def __init__(self, name: str, words: list[str], n: list[int]):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.entries = Words([words[i] for i in order])
        self.n = np.array([n[i] for i in order], dtype=np.int64)
        self.tree = Tree(self.entries.counts, LEAF)
        self.rows: list[np.ndarray] = [np.zeros(0, np.int64)] * len(self.tree.leaf_rows)
        for leaf, rows in self.tree.reached(self.entries.counts, 0, 0):
            self.rows[leaf] = rows
        _, *dealt_by = name.split(":")
        self.side, _, self.parts, self.half = map(int, dealt_by or (0, 0, 1, 0))
        self.length = int(self.entries.lengths.min())

    def candidates(self, queries: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of queries and entries whose packed counts are at most two apart."""
        steps = self.length - queries.lengths
        ways = [(np.arange(len(steps)), REACH[0])]  # long words have any length in a cell
        if self.length < LONG:
            ways = [(np.flatnonzero(steps == step), reach) for step, reach in REACH.items()]
        for rows, reach in ways:
            for leaf, reached in self.tree.reached(queries.counts[rows], *reach):
                members = self.rows[leaf]
                size = max(1, PAIRS_AT_ONCE // len(members))
                for at in range(0, len(reached), size):
                    some = rows[reached[at : at + size]]
                    apart = queries.packed[some][:, None] ^ self.entries.packed[members]
                    i, j = np.nonzero(np.bitwise_count(apart) <= 2)
                    yield some[i], members[j]

    def pairs(self, queries: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of near words: of the query and of the entry."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j in self.candidates(queries):
            kept = near(queries, i, self.entries, j)
            found.append((i[kept], j[kept]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        if self.side:  # those that share the first half too have met there
            met = [
                halves(queries.words[a], self.half, self.parts)[0]
                == halves(self.entries.words[b], self.half, self.parts)[0]
                for a, b in zip(i.tolist(), j.tolist(), strict=True)
            ]
            kept = ~np.array(met, dtype=bool)
            i, j = i[kept], j[kept]
        return i, j

    def best(self, words: list[str]) -> pa.RecordBatch:
        """For each query that has near words here: their number and the best."""
        i, j = self.pairs(Words(words))
        order = np.lexsort((j, -self.n[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[a] for a in i[first].tolist()], pa.string()),
                pa.array(np.diff(np.r_[first, len(i)]), pa.int64()),
                pa.array(self.n[j[first]], pa.int64()),
                pa.array([self.entries.words[b] for b in j[first].tolist()], pa.string()),
            ],
            names=["word", "n_near", "best_n", "best"],
        )


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, role, word, n) in the order of cells, entries before queries."""
    name, words, n, cell, asking = None, [], [], None, []
    for batch in batches:
        for at, role, word, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != name:
                if cell and asking:
                    yield cell.best(asking)
                name, words, n, cell, asking = at, [], [], None, []
            if role == ENTRY:
                words.append(word)
                n.append(times)
            elif words:
                cell = cell or Cell(name, words, n)
                asking.append(word)
                if len(asking) >= QUERIES_AT_ONCE:
                    yield cell.best(asking)
                    asking = []
    if cell and asking:
        yield cell.best(asking)


def upper_trees(words: DataFrame) -> UpperTrees:
    """Grown from the vectors of a bounded sample of the words."""
    bucket = F.least(F.length("word"), F.lit(LONG)).alias("bucket")
    sizes = {r["bucket"]: r["count"] for r in words.groupBy(bucket).count().collect()}
    steps = 1 << 30
    share = min(steps, SAMPLE * steps // max(sum(sizes.values()), 1))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = Words(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.minimum(some.lengths, LONG), pa.int32()),
                    pa.array([c.tobytes() for c in some.counts], pa.binary()),
                ],
                names=["bucket", "counts"],
            )

    picked = (
        words.where(F.pmod(F.xxhash64("word"), F.lit(steps)) < share)
        .select("word")
        .mapInArrow(in_small_batches(vectors), "bucket int, counts binary")
        .orderBy("bucket", "counts")
        .collect()
    )
    counts = np.frombuffer(b"".join(bytes(r["counts"]) for r in picked), dtype=np.int8)
    lengths = np.array([r["bucket"] for r in picked], dtype=np.int64)
    return UpperTrees(sizes, counts.reshape(-1, DIMENSIONS), lengths)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n and best of the words (word, n) that have near ones."""
    deal = dealt(upper_trees(words))
    cells = words.mapInArrow(deal, "cell string, role int, word string, n long")
    met = (
        cells.repartition("cell")
        .sortWithinPartitions("cell", "role")
        .mapInArrow(search, "word string, n_near long, best_n long, best string")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return (
        met.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("b"))
        .select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form, from rows (word, form)."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.join(ahead, "root", "left")
        further = stored(
            joined.select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        reached = further.select("word", "root")
        if further.where("moved").isEmpty():
            return reached


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the documents."""
    prepare(docs.sparkSession)
    words = vocabulary(docs, id_col, text)
    often = F.col("best_n") >= FACTOR * F.col("n")
    table = stored(
        words.join(near_words(words), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best")).alias("form"),
            F.when(often, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(table.where("form is not null"))
    return table.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
