"""Packing by power-of-two decomposition: no sequence crosses documents, and none is padded.

A document of L tokens is cut into pieces whose lengths are the binary digits of L, longest
first; what exceeds the longest sequence length becomes pieces of that length. Every piece is a
sequence of its own, whose length is a power of two. Sequences of one length form a bucket, from
which a trainer draws batches of one shape. Inside a bucket they are numbered without gaps, and
``sequence_id % buckets`` is the bucket.

Defined results: a null or empty text is the end token alone; rows with a null or repeated id are
documents like others, and equal rows have a sequence each; an empty table has no pieces; texts of
any length are cut whole. Sequences of one length that tie in everything else are numbered in the
order in which their task met them. Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimloom.llm.bpe import printable_bytes
from dimloom.llm.common import in_small_batches, prepare, small_enough, stored, whole
from dimloom.llm.pieces import Memory, OffsetTable

# Fixed value: the words of the lower-casing vocabulary, for text without the characters on
# which this module's shortcut might differ from the library.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^\s0-9a-zà-öø-ÿß]+")
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_BLANK = re.compile(rb"[\t-\r ]")
BYTES_AT_ONCE = 2 << 20
WORDS_AT_ONCE = 500

# Kinds of bytes in UTF-8.
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
_KINDS = np.full(256, OTHER, dtype=np.uint8)
_KINDS[0x21:0x7F] = SIGN
_KINDS[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = BLANK
_KINDS[0x30:0x3A] = DIGIT
_KINDS[0x41:0x5B] = _KINDS[0x61:0x7B] = LETTER
_KINDS[0x27] = OTHER  # apostrophes begin words
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def cut_at_blanks(text: bytes) -> Iterator[bytes]:
    """Parts that are not much longer than what is looked up at once."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + BYTES_AT_ONCE)
        end = blank.end() if blank else len(text)
        yield text[at:end]
        at = end


def units(text: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What a text that ends with a blank is cut into.

    Words in lower case, digits and runs of signs; but a chunk between blanks that holds a special
    token, an apostrophe, or more than ASCII and the letters from U+00C0 to U+00FF is one unit, as
    it stands. The second array says which are such chunks, the third at which bytes units start.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    kinds, lower = _KINDS[raw], _LOWER[raw]
    lead = np.flatnonzero(raw == 0xC3)
    second = raw[lead + 1]
    letters = (second != 0x97) & (second != 0xB7)
    kinds[lead[letters]] = kinds[lead[letters] + 1] = LETTER
    lower[lead[letters & (second < 0x9F)] + 1] += 0x20
    signs = np.flatnonzero(raw == ord("<"))
    kinds[signs[raw[signs + 1] == ord("|")]] = OTHER

    blank = kinds == BLANK
    starts = np.ones(len(raw), dtype=bool)
    starts[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    starts &= ~blank
    ends = np.flatnonzero(blank)
    odd = np.unique(np.searchsorted(ends, np.flatnonzero(kinds == OTHER)))
    first, last = np.where(odd > 0, ends[odd - 1] + 1, 0), ends[odd]
    edges = np.zeros(len(raw), dtype=np.int8)
    edges[first], edges[last] = 1, -1
    chunks = np.cumsum(edges, dtype=np.int8).view(bool)
    starts &= ~chunks
    starts[first] = True
    kept = np.where(chunks, raw, lower)[~blank]
    offsets = np.append(np.flatnonzero(starts[~blank]), len(kept)).astype(np.int32)
    found = pa.StringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(kept)
    )
    return found, chunks[starts], starts


class WordTokenizer:
    """Token ids by the library, remembered by word.

    This tokenizer drops white space and never joins over it, so a text's ids are those of its
    chunks in order. A chunk of plain Latin letters is cut further into words, for which the
    library's model is asked; it takes a byte as one printable character. Texts are cut and
    looked up many at once, and the model is asked for all their new words together, by a
    tokenizer that only splits at blanks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.known = Memory(lambda unit: None, 300_000)
        self.printable = {byte: char for char, byte in printable_bytes().items()}

    def _by_library(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _spelled(self, word: str) -> str:
        if word.isascii():
            return word
        return word.encode("utf-8").decode("latin-1").translate(self.printable)

    def _by_model(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each word with its ids."""
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            found = self.model.encode(" ".join(map(self._spelled, some)))
            ids = np.array(found.ids, dtype="<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(found.word_ids, minlength=len(some)))).tolist()
            for word, start, end in zip(some, [0, *ends], ends, strict=False):
                yield word, ids[start:end]

    def _words(self, chunk: str) -> list[str] | None:
        """The words of a chunk, None if only the library is sure of them."""
        if "<|" in chunk or not _PLAIN.fullmatch(chunk):
            return None
        return _WORDS.findall(chunk.lower())

    def _values(self, names: list[str], chunk: list[bool]) -> list[bytes]:
        """The ids of distinct units, of which some are chunks."""
        values = list(map(self.known.__getitem__, names))
        new = [i for i, value in enumerate(values) if value is None]
        cuts = {names[i]: self._words(names[i]) for i in new if chunk[i]}
        made = {word: self.known[word] for cut in cuts.values() if cut for word in cut}
        words = dict.fromkeys(names[i] for i in new if not chunk[i])
        words |= {word: None for word, value in made.items() if value is None}
        for word, value in self._by_model(list(words)):
            made[word] = value
            self.known.keep(word, value)
        for name, cut in cuts.items():
            value = self._by_library(name) if cut is None else b"".join(map(made.get, cut))
            made[name] = value
            self.known.keep(name, value)
        for i in new:
            values[i] = made[names[i]]
        return values

    def _together(self, texts: list[bytes]) -> list[np.ndarray]:
        found, chunk, starts = units(b"".join(text + b"\n" for text in texts))
        encoded = found.dictionary_encode()
        numbers = encoded.indices.to_numpy()
        names = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        is_chunk = np.zeros(len(names), dtype=bool)
        is_chunk[numbers[chunk]] = True
        ids = OffsetTable(self._values(names, is_chunk.tolist()), "<u4")
        lengths = np.array([len(text) + 1 for text in texts])
        counts = np.add.reduceat(starts, np.cumsum(lengths) - lengths, dtype=np.int64)
        ends = np.append(0, np.cumsum(ids.lengths[numbers]))[np.cumsum(counts)]
        return np.split(np.frombuffer(ids.joined(numbers), dtype="<u4"), ends[:-1])

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        some, size = [], 0
        for text in map(str.encode, texts):
            if some and size + len(text) > BYTES_AT_ONCE:
                yield from self._together(some)
                some, size = [], 0
            if len(text) > BYTES_AT_ONCE:
                parts = [self._together([part])[0] for part in cut_at_blanks(text)]
                yield np.concatenate(parts)
            else:
                some.append(text)
                size += len(text)
        if some:
            yield from self._together(some)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker and file."""
    return WordTokenizer(path)


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Powers of two that add up to ``tokens``, falling, none above ``longest``."""
    whole_ones, rest = divmod(tokens, longest)
    digits = [1 << bit for bit in reversed(range(longest.bit_length())) if rest >> bit & 1]
    return [longest] * whole_ones + digits


def pack(
    docs: DataFrame,
    vocabulary: str,
    longest: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the token ids themselves. ``longest`` has to be a power of two. The pieces
    are written once with a number counted per task and length. The counts, one row per task and
    length, then turn them into numbers per bucket.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest has to be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(vocabulary)
        task, counts = TaskContext.get().partitionId(), Counter()
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            encoded = tokenizer.encode_all(value.as_py() for value in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = np.concatenate([ids, end])
                start = 0
                for length in binary_lengths(len(ids), longest):
                    piece = ids[start : start + length]
                    crc = zlib.crc32(piece.tobytes())
                    row = (doc_id, start, length, crc, len(ids), task, counts[length])
                    for column, cell in zip(columns, row, strict=False):
                        column.append(cell)
                    if with_ids:
                        columns[7].append(piece)
                    counts[length] += 1
                    start += length
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_task", "_place"]
    schema = ", ".join(f"{n} long" for n in names)
    if with_ids:
        names, schema = [*names, "ids"], f"{schema}, ids array<int>"
    prepare(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text).alias("text"))
    pieces = stored(picked.mapInArrow(in_small_batches(cut), schema), "pieces")

    before = (
        Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = stored(
        pieces.groupBy("length", "_task")
        .agg(F.max("_place").alias("_last"))
        .select(
            "length",
            "_task",
            F.coalesce(F.sum(F.col("_last") + 1).over(before), F.lit(0)).alias("_before"),
        ),
        "offsets",
    )
    # Known to be small, it saves a shuffle of all pieces.
    offsets = F.broadcast(offsets) if small_enough(offsets, 128) else offsets
    buckets = longest.bit_length()
    bucket = F.log2("length").cast("long")
    number = (F.col("_before") + F.col("_place")) * buckets + bucket
    return pieces.join(offsets, ["length", "_task"]).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        number.alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
