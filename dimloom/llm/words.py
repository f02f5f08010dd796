"""64-bit hashes of all words of many texts at once, without a Python step per word.

A word is a run of bytes that a class table maps to non-zero values. Its hash is a polynomial of
those values modulo 2^64, read off a running sum over the bytes, and then mixed.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Bytes hashed in one go; also the longest word hashed this way.
SEGMENT = 1 << 18


def class_table(separators: bytes) -> np.ndarray:
    """Value of each byte in a word: 0 for a separator; A-Z count as a-z."""
    values = np.arange(1, 257, dtype=np.uint64)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[list(separators)] = 0
    return values


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(30))) * _MIX1
    hashes = (hashes ^ (hashes >> np.uint64(27))) * _MIX2
    return hashes ^ (hashes >> np.uint64(31))


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for spans up to twice SEGMENT."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(
        np.cumprod(np.r_[np.uint64(1), np.full(2 * SEGMENT, base, dtype=np.uint64)])
        for base in (_BASE, inverse)
    )


def _segment(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in one segment that begins and ends between words."""
    power, inverse = powers()
    inside = values != 0
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.r_[np.uint64(0), np.cumsum(values * power[: len(values)])]
    lengths = (ends - starts).astype(np.uint64)
    return starts, mixed((sums[ends] - sums[starts]) * inverse[starts] + lengths)


def word_hashes(texts: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin, with their
    total at the end. Newline has to be a separator."""
    blob = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_starts = np.cumsum(sizes) - sizes
    found, at = [], 0
    while at < len(blob):
        end = min(at + SEGMENT, len(blob))
        values = classes[blob[at:end]]
        if end < len(blob):
            gaps = np.flatnonzero(values == 0)
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                values = values[: end - at]
            else:  # inside a very long word
                while end < len(blob) and classes[blob[end]]:
                    rest = classes[blob[end : end + SEGMENT]] == 0
                    end += int(rest.argmax()) if rest.any() else len(rest)
                word = classes[blob[at:end]].astype("<u2").tobytes()
                if end - at > SEGMENT:
                    digest = hashlib.blake2b(word, digest_size=8).digest()
                    found.append((np.array([at]), np.frombuffer(digest, dtype="<u8")))
                    at = end
                    continue
                values = classes[blob[at:end]]
        starts, hashes = _segment(values)
        found.append((starts + at, hashes))
        at = end
    starts = np.concatenate([s for s, _ in found]) if found else np.zeros(0, np.int64)
    hashes = np.concatenate([h for _, h in found]) if found else np.zeros(0, np.uint64)
    return hashes.astype(np.uint64), np.r_[np.searchsorted(starts, text_starts), len(starts)]
