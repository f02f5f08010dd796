"""Packing, BPE and unigram counts against the tokenizers library and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dimloom.llm import bpe, packing, unigram
from tests.llm.helpers import documents, odd_documents

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

TEXTS = [
    "",
    "   ",
    "a  b\n\n c \t\n",
    "<|endoftext|>x <|ENDOFTEXT|> <|startoftext|>",
    "it's they're 'S  's IT'S",
    "\x1c a\x1d\x1e b\x85c d e",
    "日本語テキスト 한국어 ñandú ²½ªº×÷ Σας İstanbul ŒUVRE ß ẞ",
    "a" * 700 + " " * 3000 + "=-" * 800 + "0123456789" * 90,
    "́a é \U0001f600\U0001f469‍\U0001f469 �",
]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeiou thnrs'.,\n 12éßÀ_<|>", max_size=200))
def test_ids_equal_the_library(text):
    words = packing.word_tokenizer(WORD)
    ids = words.library.encode(text, add_special_tokens=False).ids
    assert words.encode(text).tolist() == ids
    coder = bpe.bpe(BYTE)
    assert coder.decode(coder.encode(text)) == text


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.text(
            alphabet="aZéÉßÿÀ×÷ªµ²½1٣'<|>,.!_ \n\t\x0b\x0c\x00\x1c\x1f\x7f\x85\xa0\u2028\u0301\u3000ΣİſŒ日\U0001f600",
            max_size=60,
        ),
        max_size=6,
    ),
    st.sampled_from([1, 7, 1000]),
)
def test_ids_of_texts_looked_up_together_equal_the_library(texts, at_once):
    words = packing.word_tokenizer(WORD)
    kept = packing.BYTES_AT_ONCE, packing.WORDS_AT_ONCE
    packing.BYTES_AT_ONCE = packing.WORDS_AT_ONCE = at_once
    try:
        got = [ids.tolist() for ids in words.encode_all([*texts, *TEXTS])]
    finally:
        packing.BYTES_AT_ONCE, packing.WORDS_AT_ONCE = kept
    library = words.library.encode
    assert got == [library(t, add_special_tokens=False).ids for t in [*texts, *TEXTS]]


def test_the_model_is_asked_for_many_new_words_at_once():
    rng = random.Random(5)
    new = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéà", k=12)) for _ in range(3000)]
    words = packing.WordTokenizer(WORD)
    words.known.entries = 1000  # fewer than there are
    model, asked = words.model, []

    class Counted:
        def encode(self, text):
            asked.append(text)
            return model.encode(text)

    words.model = Counted()
    texts = [f"{w}, {w.upper()}. {w} the" for w in new]
    got = list(words.encode_all(texts))
    assert sum(len(text.split()) for text in asked) == len(new) + 3 and len(asked) < 10
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == words.library.encode(text, add_special_tokens=False).ids
    assert len(words.known) <= 1000 and len(words.known.older) <= 1000


def test_bpe_round_trip_equals_the_library(spark, byte_library):
    docs = documents(spark, [*TEXTS, None])
    got = {r["doc_id"]: r for r in bpe.round_trip_digests(docs, BYTE).collect()}
    for i, text in enumerate([*TEXTS, ""]):
        ids = byte_library.encode(text, add_special_tokens=False).ids
        told = ",".join(map(str, ids)).encode()
        decoded = byte_library.decode(ids, skip_special_tokens=False).encode()
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(told).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(decoded).hexdigest()


def test_a_memory_that_is_full_starts_afresh():
    coder = bpe.BacktrackingBpe(BYTE)
    coder.chunks.entries = coder.pieces.entries = 2
    text = "several words that do not fit, into; two entries"
    assert coder.decode(coder.encode(text)) == text and len(coder.chunks) <= 2


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aeiou thnrs.", max_size=60))
def test_unigram_counts_equal_plain_dynamic_programming(text):
    counter = unigram.unigram_counter(RANKS)

    def plain(word: bytes) -> int:
        best = [0]
        for end in range(1, len(word) + 1):
            costs = (best[s] + counter.cost[word[s:end]] for s in range(end) if word[s:end] in counter.cost)
            best.append(min(costs))
        return best[-1] % unigram.UNIT

    expected = sum(plain(p.encode()) for p in bpe.PRE_TOKENS.findall(text))
    assert counter.count_texts([text, text]) == [expected, expected]


def test_packing_covers_every_id_once_without_padding(spark):
    rng = random.Random(4)
    texts = [*TEXTS, " ".join(rng.choice(["the", "of", "stone"]) for _ in range(5000))]
    rows = packing.pack(documents(spark, [*texts, None]), WORD, with_ids=True).collect()
    tokenizer = packing.word_tokenizer(WORD)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, text in enumerate([*texts, ""]):
        ids = np.append(tokenizer.library.encode(text, add_special_tokens=False).ids, 1)
        ids = ids.astype("<u4")
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [r["start"] for r in pieces] == list(
            np.cumsum([0, *(r["length"] for r in pieces)])[:-1]
        )
        assert np.concatenate([r["ids"] for r in pieces]).tolist() == ids.tolist()
        for r in pieces:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            assert r["length"] <= 2048 and r["length"].bit_count() == 1
            assert r["doc_tokens"] == len(ids) and r["offset"] == 0
            assert r["sequence_id"] % 12 == r["length"].bit_length() - 1
    for bucket in range(12):  # no gaps inside a bucket
        numbers = sorted(r["sequence_id"] // 12 for r in rows if r["sequence_id"] % 12 == bucket)
        assert numbers == list(range(len(numbers)))


def test_packing_wants_a_power_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(documents(spark, ["a"]), WORD, longest=1000)


def test_odd_rows_and_empty_tables(spark):
    odd = odd_documents(spark)
    for run in (
        lambda d: packing.pack(d, WORD).groupBy("doc_id", "doc_tokens").count(),
        lambda d: bpe.round_trip_digests(d, BYTE),
        lambda d: unigram.token_counts(d, RANKS),
    ):
        assert run(odd.limit(0)).collect() == []
    assert bpe.round_trip_digests(odd, BYTE).count() == odd.count()
    assert unigram.token_counts(odd, RANKS).where("n_tokens = 0").count() == 3
    pieces = packing.pack(odd, WORD)
    assert pieces.where("start = 0").count() == odd.count()


def test_ids_of_characters_new_to_one_of_the_libraries(spark, byte_library):
    texts = ["[\U0003240a't", "x౜'s", "!\U000187f8't", "ꟍa1 ꟎b", "\U000323b1 \U000323b1x", "a\U0001e5d0 1\U0001e5f1"]
    assert not any(map(bpe.is_alike, texts[:3]))
    coder = bpe.bpe(BYTE)
    for text in texts:
        assert coder.encode(text).tolist() == byte_library.encode(text, add_special_tokens=False).ids


def test_every_code_point_is_split_as_the_library_does():
    """Before and after a letter, a number, a sign and a blank."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        text = "".join(f"a{c}b 1{c}2 !{c}? {c}'s\n" for c in points[at : at + 20_000])
        want = [text[a:b] for _, (a, b) in bpe._LIBRARY.pre_tokenize_str(text)]
        chunks = bpe.spaced_chunks(text) if at else [text]
        assert [p for chunk in chunks for p in bpe.pre_tokens(chunk)] == want


def test_counts_of_very_long_words(monkeypatch):
    counter = unigram.UnigramCounter(RANKS)
    rng = random.Random(3)
    word = "".join(rng.choice("abcdeinst") for _ in range(3000))
    (_, count), = counter.trie_counts([word.encode()])
    assert counter.long_count(word.encode()) == count
    monkeypatch.setattr(unigram, "LONG", 100)
    assert unigram.UnigramCounter(RANKS).count_texts([word, "a " + word]) == [count, 1 + counter.long_count(b" " + word.encode())]
