"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

The model gives each token of a vocabulary a cost; a pre-token is cut into the tokens of least
total cost, and of the fewest tokens among equals. The distinct pre-tokens of a batch that are
not known yet go into a trie, walked depth first: words sharing a prefix share its forward costs,
and a word's count is stored at its end. A document's count is the sum over its pre-tokens.

The cost of a token follows Zipf's law by its rank in the vocabulary, which the public files are
ordered by; nothing is trained on tokens. Costs are integers, so results do not depend on the
order of additions.

Defined results: null and empty texts have no tokens; null ids and repeated rows are counted each;
an empty table gives no rows; texts of any length are counted whole, and words of more than
``LONG`` bytes by a window over the last scores alone; further columns, whatever their names, are
not looked at. Cuts that tie in cost and tokens have the same count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.bpe import pre_tokens
from dimloom.llm.common import in_small_batches, prepare, whole
from dimloom.llm.pieces import LONGEST_KEPT, MEMORY_ENTRIES, spaced_chunks

ONE_TOKEN = 1  # what a token adds below the cost's own unit
UNIT = 1 << 24  # so the low bits count tokens, for words up to LONG bytes
LONG = 1 << 16


def zipf_cost(rank: int) -> int:
    """Bits of a token by its rank, in thousandths."""
    return round(1000 * log2(rank + 2))


class UnigramCounter:
    """Costs of the byte strings of a rank file, and counts of pre-tokens."""

    def __init__(self, path: str):
        import base64

        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.cost = {
            base64.b64decode(token): zipf_cost(int(rank)) * UNIT + ONE_TOKEN
            for token, rank in pairs
        }
        lengths: dict[int, set[int]] = {}
        for token in self.cost:
            lengths.setdefault(token[-1], set()).add(len(token))
        # How long tokens can be that end with a byte.
        self.lengths = {last: sorted(some) for last, some in lengths.items()}
        self.longest = max(map(len, self.cost))
        self.counts: dict[str, int] = {}

    def long_count(self, word: bytes) -> int:
        """Tokens of a very long word. Only the last forward scores are kept, no longer token
        reaches further back, and costs and counts are kept apart, so none is too large."""
        size = self.longest + 1
        forward: list[tuple[int, int]] = [(0, 0)] * size
        cost, lengths = self.cost, self.lengths
        for end in range(1, len(word) + 1):
            best = None
            for length in lengths[word[end - 1]]:
                if length > end:
                    break
                one = cost.get(word[end - length : end])
                if one is not None:
                    bits, tokens = forward[(end - length) % size]
                    total = bits + one // UNIT, tokens + 1
                    if best is None or total < best:
                        best = total
            forward[end % size] = best
        return forward[len(word) % size][1]

    def trie_counts(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, int]]:
        """Each distinct word with its count; a sorted list is a trie in depth-first order."""
        forward, before = [0], b""
        cost, lengths = self.cost, self.lengths
        for word in sorted(set(words)):
            if len(word) > LONG:
                yield word, self.long_count(word)
                continue
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del forward[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best = -1
                for length in lengths[word[end - 1]]:
                    if length > end:
                        break
                    one = cost.get(word[end - length : end])
                    if one is not None:
                        total = forward[end - length] + one
                        if best < 0 or total < best:
                            best = total
                forward.append(best)
            before = word
            yield word, forward[-1] % UNIT

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the counts of chunks are kept for the next call."""
        known = self.counts
        if len(known) >= 2 * MEMORY_ENTRIES:
            known.clear()
        chunks = [spaced_chunks(text) for text in texts]
        new = {c for some in chunks for c in some if c not in known}
        cut = {c: [p.encode("utf-8") for p in pre_tokens(c)] for c in new}
        counts = dict(self.trie_counts(p for pieces in cut.values() for p in pieces))
        told = {c: sum(map(counts.__getitem__, pieces)) for c, pieces in cut.items()}
        long_ones = {c: n for c, n in told.items() if len(c) > LONGEST_KEPT}
        known.update(told)
        totals = [sum(map(known.__getitem__, some)) for some in chunks]
        for chunk in long_ones:
            del known[chunk]
        return totals


@cache
def unigram_counter(path: str) -> UnigramCounter:
    """One per Python worker and file."""
    return UnigramCounter(path)


def token_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and n_tokens of every whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = unigram_counter(vocabulary)
        for batch in batches:
            totals = counter.count_texts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64())], names=["doc_id", "n_tokens"]
            )

    prepare(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text).alias("text"))
    return picked.mapInArrow(in_small_batches(count), "doc_id long, n_tokens long")
