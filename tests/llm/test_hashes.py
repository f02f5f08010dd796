"""Word hashes and Lempel-Ziv fingerprints."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimloom.llm import jaccard, lempel_ziv, words
from tests.llm.helpers import documents, odd_documents


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbB é\t\n", max_size=30), max_size=6))
def test_words_are_told_apart(texts):
    encoded = [t.encode() for t in texts]
    hashes, first = words.word_hashes(encoded, jaccard.CLASSES)
    found = [
        w.lower() for t in encoded for w in re.findall(rb"[^\x20\x09-\x0d]+", t)
    ]
    assert len(found) == len(hashes) == first[-1]
    assert len(set(found)) == len(set(hashes.tolist())) == len(set(zip(found, hashes.tolist(), strict=True)))


def test_very_long_words_and_texts_over_several_segments():
    long_word = b"a" * (words.SEGMENT + 10)
    texts = [long_word, b"x " + long_word + b" y", b"q" * words.SEGMENT + b" end", b"one two " * 90_000]
    hashes, first = words.word_hashes(texts, jaccard.CLASSES)
    assert np.diff(first).tolist() == [1, 3, 2, 180_000]
    assert hashes[0] == hashes[2] and len(set(hashes[6:].tolist())) == 2


def phrases(text: str) -> set[str]:
    known, pending = set(), ""
    for char in text:
        pending += char
        if pending not in known:
            known.add(pending)
            pending = ""
    return known


def by_definition(text: str) -> np.ndarray:
    found = sorted(phrases(text))
    sizes = np.array([len(p) for p in found], dtype=np.int64)
    ends = np.cumsum(sizes)
    codes = np.frombuffer("".join(found).encode("utf-32-le"), "<u4")
    hashes = lempel_ziv.span_hashes(codes, ends - sizes, ends)
    smallest = np.full(lempel_ziv.BINS, 2**64 - 1, dtype=np.uint64)
    np.minimum.at(smallest, (hashes >> np.uint64(57)).astype(int), hashes)
    return lempel_ziv.as_print(smallest)


def test_fingerprints_by_definition(spark):
    texts = ["abcabcabcabd" * 9, "", "é\U0001f600x" * 50, None, "zz", "abcabcabcabd" * 9]
    rows = lempel_ziv.document_fingerprints(documents(spark, texts)).collect()
    got = {r["doc_id"]: r for r in rows}
    texts = [t or "" for t in texts]
    for i, text in enumerate(texts):
        after = texts[i - 1]  # by descending id; after the last comes the first
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        row = got[i]
        one, other, following = map(by_definition, (text, edited, after))
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert [row["fingerprint"], row["edited_fingerprint"]] == lempel_ziv.hexadecimal(
            np.stack([one, other])
        )
        assert row["near_edited"] == lempel_ziv.likeness(one[None], other[None])[0]
        assert row["near_next"] == lempel_ziv.likeness(one[None], following[None])[0]
    assert got[0]["fingerprint"] == got[5]["fingerprint"]


def test_likeness_follows_the_share_of_common_phrases(spark):
    text = " ".join(f"word{i * i % 977}" for i in range(900))
    changed = text[:6000] + "!" + text[6001:]
    alike, other = lempel_ziv.fingerprints([text, "?" * 3000], [len(text), 0], ["", ""]).whole
    near = lempel_ziv.fingerprints([changed], [0], [""]).whole
    near_value = lempel_ziv.likeness(alike[None], near)[0]
    assert near_value > 0.6 > 0.1 > lempel_ziv.likeness(alike[None], other[None])[0]


def test_odd_rows_and_empty_tables(spark):
    odd = odd_documents(spark)
    assert lempel_ziv.document_fingerprints(odd.limit(0)).collect() == []
    rows = lempel_ziv.document_fingerprints(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in rows)
    one = lempel_ziv.document_fingerprints(documents(spark, ["just one"])).first()
    assert one["near_next"] == 1.0


def in_turn(rows: list[tuple]) -> list[tuple]:
    """Rows (doc_id, text) by descending id, without one last, then by the hash."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))


def test_missing_and_repeated_ids_are_dealt_by_their_texts(spark, monkeypatch):
    """Nine of ten ids are missing or the same; results are those of the whole order."""
    texts = [f"text number {i} of {i % 13} " * (1 + i % 4) for i in range(1500)]
    ids = [i if i % 10 == 0 else None if i % 2 else 7 for i in range(1500)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    docs = docs.unionByName(docs.limit(40)).repartition(5)
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    ordered = in_turn([tuple(r) for r in hashed])
    want = sorted(
        str((one[0], len(one[1]), hashlib.sha256((one[1][: len(one[1]) - len(one[1]) // 3] + after[1][: len(one[1]) // 3]).encode()).hexdigest()))
        for one, after in zip(ordered, ordered[1:] + ordered[:1], strict=True)
    )
    got = lempel_ziv.document_fingerprints(docs).select("doc_id", "n_chars", "edited_sha256")
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    o1, o2 = lempel_ziv.order_of("doc_id", "text")
    placed = docs.select(o1.alias("o1"), o2.alias("o2"))
    cuts = lempel_ziv.cut_points(placed, 24)
    sizes = Counter(bisect_right(cuts, tuple(r)) for r in placed.collect())
    assert len(sizes) == 24 and max(sizes.values()) < 3 * 1540 / 24
