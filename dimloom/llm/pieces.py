"""Text split at white space, with a bounded memory of what each chunk turned into.

Most chunks of a corpus recur, so work per chunk is done once per Python worker and then looked
up. A memory that is full becomes the older one, from which chunks that recur are taken over
until the new one is full: its size never depends on the data, and frequent chunks stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

MEMORY_ENTRIES = 200_000  # in each of the two
LONGEST_KEPT = 48

# Splits like the byte-level pre-tokenizer does around white space: one blank may lead a chunk.
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# Python counts these four as white space, the tokenizers do not.
SEPARATORS = re.compile("[\x1c-\x1f]")


class Memory(dict):
    """value = memory[chunk], made by the given function where it is not known yet.

    Of a chunk for which the function has None, nothing is kept.
    """

    def __init__(self, make: Callable[[str], object], entries: int = MEMORY_ENTRIES):
        super().__init__()
        self.make, self.entries = make, entries
        self.older: dict[str, object] = {}

    def __missing__(self, chunk: str):
        value = self.older.pop(chunk, None)
        if value is None:
            value = self.make(chunk)
        if value is not None:
            self.keep(chunk, value)
        return value

    def keep(self, chunk: str, value: object) -> None:
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[chunk] = value


def spaced_chunks(text: str) -> list[str]:
    """Chunks no byte-level pre-token crosses; joined they are the text."""
    if SEPARATORS.search(text):
        return [text]
    return _SPACED.findall(text)


class OffsetTable:
    """Byte strings by number, laid end to end, and copied out for whole id arrays at once.

    ``dtype`` is what the strings consist of; lengths are counted in it.
    """

    def __init__(self, strings: list[bytes], dtype: str = "u1"):
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.lengths //= np.dtype(dtype).itemsize
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.data = np.frombuffer(b"".join(strings), dtype=dtype)

    def joined(self, ids: np.ndarray, at_once: int = 1 << 18) -> bytes:
        parts = []
        for first in range(0, len(ids), at_once):
            some = ids[first : first + at_once]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            shift = np.repeat(self.starts[some] - (ends - lengths), lengths)
            shift += np.arange(len(shift))
            parts.append(self.data[shift].tobytes())
        return b"".join(parts)
