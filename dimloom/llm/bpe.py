"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A sequence of tokens is what the merges give exactly if every two neighbours are *compatible*:
merging the text of both together keeps the border between them. So a text is encoded from left
to right, taking the longest token that starts here (found by one Aho-Corasick pass), then its
longest prefix that is a token, and so on, until one is compatible with the token before; if none
is, the position is a dead end and the token before is shortened. A prefix of the text has only
one exact encoding, so a dead end stays one and the work is linear.

Texts are split beforehand as the pre-tokenizer does, and the special token stands for itself
where its string occurs, as in the library. Characters that the library classes differently from
the pattern used here are noticed, and chunks that hold one are split by the library's own
pre-tokenizer.

Defined results: null texts count as empty, empty texts have no tokens; null ids and repeated rows
are encoded each; an empty table gives no rows; texts of any length are encoded whole; further
columns, whatever their names, are not looked at. There are no ties: every merge has its rank, and
of equal pairs the leftmost merges first.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from dimloom.llm.common import in_small_batches, prepare, whole
from dimloom.llm.pieces import Memory, OffsetTable, spaced_chunks

NEVER = 1 << 60
# Fixed value: the public pattern that splits text before byte-level merges, with white space
# as Unicode defines it.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_LIBRARY = ByteLevel(add_prefix_space=False)


class AlikeCharacters(dict):
    """If the library classes a character as the pattern here does, asked once for each.

    Both know letters by the Unicode version they were built with, so characters that are new to
    one of them differ.
    """

    def __missing__(self, char: str) -> bool:
        classes = [
            kind
            for kind, probe in (("letter", "a"), ("number", "1"), ("other", "!"))
            if len(_LIBRARY.pre_tokenize_str(probe + char)) == 1
        ]
        ours = [
            kind
            for kind, probe in (("letter", "a"), ("number", "1"), ("other", "!"))
            if len(PRE_TOKENS.findall(probe + char)) == 1
        ]
        self[char] = classes == ours and char.isalpha() == (ours == ["letter"])
        return self[char]


ALIKE = AlikeCharacters()


def is_alike(chunk: str) -> bool:
    return chunk.isascii() or all(map(ALIKE.__getitem__, chunk))


def pre_tokens(chunk: str) -> list[str]:
    """The chunk split as the library does."""
    if is_alike(chunk):
        return PRE_TOKENS.findall(chunk)
    return [chunk[start:end] for _, (start, end) in _LIBRARY.pre_tokenize_str(chunk)]


def printable_bytes() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable ones stand for themselves, the
    others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BacktrackingBpe:
    """A byte-level BPE vocabulary whose file is in the format of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        to_byte = printable_bytes()
        raw = {t: bytes(to_byte[c] for c in t) for t in told["model"]["vocab"]}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"] if t["special"]}
        ids = {raw[t]: i for t, i in told["model"]["vocab"].items()}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.strings = [b""] * size
        for string, i in [*ids.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.strings[i] = string
        self.rank = [-1] * size  # of the merge that makes a token; single bytes come first
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(told["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            halves = ids[raw[left]], ids[raw[right]]
            made = ids[raw[left] + raw[right]]
            self.merge[halves] = rank
            if self.halves[made] is None:
                self.halves[made], self.rank[made] = halves, rank
        self.compatible: dict[tuple[int, int], bool] = {}
        self._index(ids)
        self.offsets = OffsetTable(self.strings)
        self.decimals = OffsetTable([b"%d," % i for i in range(size)])
        self.split_at = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self.pieces = Memory(self._piece, 60_000)
        self.chunks = Memory(self._chunk)

    def _index(self, ids: dict[bytes, int]) -> None:
        """Tokens that the merges can reach at all, their automaton and their shorter prefixes."""
        self.tokens, self.shorter = {}, [-1] * len(self.strings)
        self.automaton = ahocorasick.Automaton()
        for string, i in sorted(ids.items(), key=lambda item: (len(item[0]), item[1])):
            halves = self.halves[i]
            if len(string) > 1 and (halves is None or not self._holds(*halves, self.rank[i])):
                continue
            self.tokens[string.decode("latin-1")] = i
        for string, i in self.tokens.items():
            self.automaton.add_word(string, (len(string), i))
            for end in range(len(string) - 1, 0, -1):
                if string[:end] in self.tokens:
                    self.shorter[i] = self.tokens[string[:end]]
                    break
        self.automaton.make_automaton()

    def _holds(self, left: int, right: int, before: int = NEVER) -> bool:
        """Does no merge ranked below ``before`` cross the border of the two tokens?

        Tokens that touch the border are those made on the way to ``left``, at its right edge,
        and on the way to ``right``, at its left edge. A pair of them merges if its rank comes
        before both have become part of larger ones. The leftmost of equal pairs merges first.
        """
        on_left, until_left = left, before
        while True:
            on_right, until_right = right, before
            while True:
                rank = self.merge.get((on_left, on_right), NEVER)
                if rank < until_left and (rank < until_right or rank == until_right < before):
                    return False
                if self.halves[on_right] is None:
                    break
                until_right = self.rank[on_right]
                on_right = self.halves[on_right][0]
            if self.halves[on_left] is None:
                return True
            until_left = self.rank[on_left]
            on_left = self.halves[on_left][1]

    def _fits(self, left: int, right: int) -> bool:
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= 2_000_000:
                self.compatible.clear()
            known = self.compatible[left, right] = self._holds(left, right)
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one pre-token."""
        data = piece.encode("utf-8").decode("latin-1")
        if data in self.tokens:
            return [self.tokens[data]]
        longest = [-1] * len(data)
        for end, (length, token) in self.automaton.iter(data):
            longest[end + 1 - length] = token  # matches come by their ends: the longest is last
        ids: list[int] = []
        dead: set[int] = set()
        at, candidate = 0, longest[0]
        while at < len(data):
            while candidate >= 0:
                end = at + len(self.strings[candidate])
                if end not in dead and (not ids or self._fits(ids[-1], candidate)):
                    break
                candidate = self.shorter[candidate]
            if candidate >= 0:
                ids.append(candidate)
                at = end
                candidate = longest[at] if at < len(data) else -1
            else:
                dead.add(at)
                last = ids.pop()
                at -= len(self.strings[last])
                candidate = self.shorter[last]
        return ids

    def _piece(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece), dtype="<u2").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if (chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha())) and is_alike(chunk):
            return self._piece(chunk)
        return b"".join(map(self.pieces.__getitem__, pre_tokens(chunk)))

    def _ordinary(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, spaced_chunks(text)))

    def encode(self, text: str) -> np.ndarray:
        if self.split_at and any(s in text for s in self.special):
            parts = (
                np.array([self.special[part]], dtype="<u2").tobytes()
                if part in self.special
                else self._ordinary(part)
                for part in self.split_at.split(text)
            )
            return np.frombuffer(b"".join(parts), dtype="<u2")
        return np.frombuffer(self._ordinary(text), dtype="<u2")

    def decode(self, ids: np.ndarray) -> str:
        return self.offsets.joined(ids).decode("utf-8", errors="replace")


@cache
def bpe(path: str) -> BacktrackingBpe:
    """One per Python worker and file."""
    return BacktrackingBpe(path)


def round_trip_digests(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text they decode to."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(vocabulary)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                ids = coder.encode(value.as_py())
                told = hashlib.sha256(coder.decimals.joined(ids)[:-1]).hexdigest()
                decoded = hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest()
                rows.append((len(ids), told, decoded))
            counts, told, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(told, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    prepare(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text).alias("text"))
    return picked.mapInArrow(
        in_small_batches(digest),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
