"""Lempel-Ziv phrase fingerprints: texts that compress alike get alike fingerprints.

A text is parsed into dictionary phrases: each is the shortest run of characters that is not a
phrase yet. The set of phrases is hashed, and the smallest hash in each of ``BINS`` ranges makes
the fingerprint, four hexadecimal digits a bin, ``ffff`` where no phrase fell. The likeness of two
fingerprints is the share of equal bins among those that are filled in either, an estimate of the
Jaccard similarity of the phrase sets. Equal texts have equal fingerprints.

The query compares every text to an edited form, made with the start of the next document. Cut
points over ids and hashes of texts deal the documents into ranges, and the first text of a range
is also sent to the one before; so texts are shuffled once, and each task streams through its
ranges in order. The parse of an unchanged beginning is shared by both forms of a text.

Defined results: null texts count as empty; empty texts have no phrases, and two empty sets are
alike to 1.0; documents without an id come last; those of one id, or without one, come in the order
of a hash of their texts, and are dealt to ranges by it as well; rows equal in id and text follow
each other, in one task. A single document is its own successor; an empty table gives no rows.
Texts of any length are parsed whole. Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.llm.common import in_small_batches, prepare, stored, whole
from dimloom.llm.words import SEGMENT, mixed, powers

BINS = 128
EMPTY = 0xFFFF
SAMPLED = 50  # rows of the sample in a range
_STEPS = 1 << 40
_PARTITIONS = "spark.sql.shuffle.partitions"
_LOWEST = -(1 << 63)


def phrases(text: str, known: set[str], pending: str = "") -> tuple[list[str], str]:
    """New phrases of a text, added to the known ones, and the rest that is no new phrase."""
    found: list[str] = []
    add, keep = known.add, found.append
    for char in text:
        pending += char
        if pending not in known:
            add(pending)
            keep(pending)
            pending = ""
    return found, pending


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of code points; spans are in order and do not overlap."""
    power, inverse = powers()
    hashes = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(int(np.searchsorted(ends, base + SEGMENT, side="right")), first + 1)
        values = codes[base : int(ends[last - 1])].astype(np.uint64) + np.uint64(1)
        sums = np.r_[np.uint64(0), np.cumsum(values * power[: len(values)])]
        a, b = starts[first:last] - base, ends[first:last] - base
        hashes[first:last] = mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        first = last
    return hashes


@dataclass
class Prints:
    """Fingerprints of some texts and of their edited forms."""

    whole: np.ndarray
    edited: np.ndarray


def as_print(smallest: np.ndarray) -> np.ndarray:
    """Smallest hashes cut to 16 bits a bin."""
    cut = ((smallest >> np.uint64(16)) % np.uint64(EMPTY)).astype(np.uint16)
    cut[smallest == np.iinfo(np.uint64).max] = EMPTY
    return cut


def fingerprints(texts: list[str], kept: list[int], replaced: list[str]) -> Prints:
    """Of each text, and of its first ``kept`` characters followed by the replacement."""
    strings: list[str] = []
    lengths: list[int] = []
    # Three sets a text: phrases of the kept part, of the own rest, of the replaced rest.
    sets: list[int] = []
    starts_of: list[tuple[int, int]] = []  # string, number of phrases
    for i, (text, keep, other) in enumerate(zip(texts, kept, replaced, strict=True)):
        known: set[str] = set()
        shared, pending = phrases(text[:keep], known)
        branch = known.copy() if other else known
        own, _ = phrases(text[keep:], known, pending)
        lengths += map(len, shared)
        lengths += map(len, own)
        sets += [3 * i] * len(shared) + [3 * i + 1] * len(own)
        strings.append(text)
        starts_of.append((len(text), len(shared) + len(own)))
        if other:
            new, _ = phrases(other, branch, pending)
            lengths += map(len, new)
            sets += [3 * i + 2] * len(new)
            strings.append(pending + other)
            starts_of.append((len(pending) + len(other), len(new)))
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    size = np.array(lengths, dtype=np.int64)
    string_sizes = np.array([s for s, _ in starts_of], dtype=np.int64)
    counts = np.array([c for _, c in starts_of], dtype=np.int64)
    # A phrase starts where the one before ends; the first of a string where the string does.
    running = np.cumsum(size) - size
    first = np.cumsum(counts) - counts
    before = np.r_[running, 0][np.minimum(first, len(running))]
    shift = np.cumsum(string_sizes) - string_sizes - before
    starts = running + np.repeat(shift, counts)
    hashes = span_hashes(codes, starts, starts + size)
    smallest = np.full(3 * len(texts) * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    bins = (hashes >> np.uint64(57)).astype(np.int64)
    np.minimum.at(smallest, np.array(sets, dtype=np.int64) * BINS + bins, hashes)
    kept_part, own_rest, new_rest = smallest.reshape(len(texts), 3, BINS).transpose(1, 0, 2)
    return Prints(
        as_print(np.minimum(kept_part, own_rest)), as_print(np.minimum(kept_part, new_rest))
    )


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row, from 0 to 1."""
    filled = (one != EMPTY) | (other != EMPTY)
    equal = (filled & (one == other)).sum(axis=1)
    total = filled.sum(axis=1)
    return np.where(total == 0, 1.0, equal / np.maximum(total, 1))


def hexadecimal(prints: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in prints]


def compared(rows: list[tuple]) -> list[tuple]:
    """Results of all rows but the last, each compared to the row after it."""
    texts = [row[3] for row in rows]
    kept = [len(text) - len(text) // 3 for text in texts]
    others = [b[: len(a) // 3] for a, b in zip(texts, texts[1:], strict=False)] + [""]
    prints = fingerprints(texts, kept, others)
    near_edited = likeness(prints.whole, prints.edited)
    near_next = likeness(prints.whole[:-1], prints.whole[1:])
    told, told_edited = hexadecimal(prints.whole), hexadecimal(prints.edited)
    out = []
    for i, ((bucket, follows, doc_id, text), after) in enumerate(
        zip(rows, rows[1:], strict=False)
    ):
        if follows or after[0] != bucket:
            continue
        edited = (text[: kept[i]] + others[i]).encode("utf-8", "surrogatepass")
        digest = hashlib.sha256(edited).hexdigest()
        near = float(near_edited[i]), float(near_next[i])
        out.append((doc_id, len(text), digest, told[i], told_edited[i], *near))
    return out


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, follows, doc_id, text) come in order; only the last one is carried on."""
    held: list[tuple] = []
    for batch in batches:
        rows = held + list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        if not rows:
            continue
        columns = list(zip(*compared(rows), strict=True)) or [()] * len(RESULT)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT
        )
        held = rows[-1:]


def order_of(id_col: str, text: str) -> tuple[Column, Column]:
    """Two numbers that rise with the order of documents: by descending id, those without one
    last, then by a hash of the text."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    return F.bitwise_not(key), F.xxhash64(whole(text))


def cut_points(placed: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """Cuts between about even ranges of the order, from a sample of about ``SAMPLED`` rows a
    range. Rows equal in both numbers count once, so none can flood it."""
    there = placed.count()
    share = min(_STEPS, SAMPLED * ranges * _STEPS // max(there, 1))
    turn = F.pmod(F.xxhash64("o1", "o2", F.lit(6)), F.lit(_STEPS))
    rows = placed.where(turn < share).distinct().toLocalIterator()
    found = sorted((row["o1"], row["o2"]) for row in rows)
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def document_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    The last third of a text, rounded down, is replaced by as many characters from the start of
    the next document by descending id, or all of it; after the last comes the first.
    """
    spark = docs.sparkSession
    prepare(spark)
    o1, o2 = order_of(id_col, text)
    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        whole(text).alias("text"),
        o1.alias("o1"),
        o2.alias("o2"),
    )
    # Ranges are many more than partitions, so that hashing deals them evenly.
    cuts = cut_points(picked.select("o1", "o2"), 3 * int(spark.conf.get(_PARTITIONS)))

    @F.pandas_udf("long")
    def range_of(o1: pd.Series, o2: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, pair) for pair in zip(o1, o2, strict=True)])

    # One row a range: its first document, and the range before it, which needs that as well.
    in_turn = Window.orderBy("bucket")
    all_ranges = in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.max("bucket").over(all_ranges)
    firsts = (
        picked.select("o1", "o2")
        .withColumn("bucket", range_of("o1", "o2"))
        .groupBy("bucket")
        .agg(F.min(F.struct("o1", "o2")).alias("first"))
        .select(
            "first.o1", "first.o2", F.coalesce(F.lag("bucket").over(in_turn), last).alias("before")
        )
    )
    # Its text is taken once, however many rows hold it.
    following = (
        picked.join(F.broadcast(stored(firsts, "firsts")), ["o1", "o2"])
        .groupBy("before", "o1", "o2")
        .agg(F.min("text").alias("text"))
        .select(
            F.col("before").alias("bucket"),
            F.lit(True).alias("follows"),
            F.lit(None).cast("long").alias("doc_id"),
            "text",
            "o1",
            "o2",
        )
    )
    dealt = picked.select(
        range_of("o1", "o2").alias("bucket"),
        F.lit(False).alias("follows"),
        "doc_id",
        "text",
        "o1",
        "o2",
    ).unionByName(following)
    sorted_rows = (
        dealt.repartition("bucket")
        .sortWithinPartitions("bucket", "follows", "o1", "o2", "text")
        .select("bucket", "follows", "doc_id", "text")
    )
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return sorted_rows.mapInArrow(in_small_batches(in_order), schema)
