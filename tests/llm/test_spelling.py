"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dimloom.llm import spelling
from tests.llm.helpers import documents, odd_documents

LETTERS = "abcdeéèàÿ×"


def counted(rows) -> dict[str, int]:
    counts: Counter[str] = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            if doc_id is not None:
                value = zlib.crc32(f"{doc_id}:{run}".encode())
                if value % 97 == 0:
                    at = value % len(run)
                    run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_pairs(words: dict[str, int]) -> dict[str, tuple]:
    found, forms = {}, {}
    for word, n in words.items():
        near = sorted((-m, other) for other, m in words.items() if one_apart(word, other))
        if near and -near[0][0] >= 2 * n:
            forms[word] = near[0][1]
        found[word] = (n, len(near))
    out = {}
    for word, (n, n_near) in found.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out[word] = (form, root, n, n_near, words.get(form))
    return out


def as_dict(rows) -> dict[str, tuple]:
    rows = rows.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def variants(rng: random.Random, word: str) -> str:
    at, letter = rng.randrange(len(word)), rng.choice(LETTERS)
    return rng.choice((word[:at], word[: at + 1])) + rng.choice((letter, "")) + word[at + 1 :]


def corpus(rng: random.Random) -> list[str | None]:
    words = ["".join(rng.choices(LETTERS, k=rng.randint(4, 9))) for _ in range(150)]
    words += [variants(rng, rng.choice(words)) for _ in range(500)]
    long = "".join(rng.choices("abcde", k=61))
    words += [long + "a" * i for i in range(6)] + [long + "b" + "a" * i for i in range(6)]
    words += ["ab" * 40, "ab" * 39 + "aab", "ba" * 40]
    words += ["".join(rng.sample("aabbccdd", 8)) for _ in range(150)]  # anagrams
    texts: list[str | None] = [None, "", "Ä1ö2", " . "]
    for _ in range(60):
        some = rng.choices(words, [1 + (i % 7) ** 2 for i in range(len(words))], k=120)
        texts.append(rng.choice(" -.0ıĀ").join(w.upper() if rng.random() < 0.2 and w.isascii() else w for w in some))
    return texts


@pytest.mark.parametrize("cell", [spelling.CELL, 60, 12])
def test_equals_all_pairs(spark, monkeypatch, cell):
    """Small cells have many words go to several cells, and anagrams dealt by halves."""
    monkeypatch.setattr(spelling, "CELL", cell)
    texts = corpus(random.Random(11))
    want = by_pairs(counted(enumerate(texts)))
    assert sum(form is not None for form, *_ in want.values()) > 50
    assert as_dict(spelling.spelling_forms(documents(spark, texts))) == want


def test_leaves_that_counts_cannot_cut_are_dealt_by_halves(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 10)
    rng = random.Random(2)
    made = {"".join(rng.sample("aabbccddee", 10)) for _ in range(200)}
    words = [*made, *{w[:-1] + "a" for w in made}, *{"f" + w[1:] for w in made}, *{w[1:] for w in made}]
    want = by_pairs({w: 3 for w in words})
    frame = spark.createDataFrame([(w, 3) for w in set(words)], "word string, n long")
    trees = spelling.upper_trees(frame)
    assert any(parts > 1 for some in trees.parts.values() for parts in some)
    got = {r["word"]: r["n_near"] for r in spelling.near_words(frame).collect()}
    assert got == {w: n_near for w, (_, _, _, n_near, _) in want.items() if n_near}


def test_a_tree_reaches_every_box_within_an_edit():
    rng = np.random.default_rng(3)
    entries = rng.integers(0, 3, size=(300, spelling.DIMENSIONS)).astype(np.int8)
    tree = spelling.Tree(entries, 5)
    own = {int(r): leaf for leaf, rows in tree.reached(entries, 0, 0) for r in rows}
    assert sorted(own) == list(range(300))
    moved = entries.copy()
    for row in moved:
        up, down = rng.choice(spelling.DIMENSIONS, 2, replace=False)
        row[up] += 1
        row[down] = max(row[down] - 1, 0)
    for queries, rises, falls in ((moved, 1, 1), (entries, 1, 1), (entries, 0, 1), (entries, 1, 0)):
        reached = {(leaf, int(r)) for leaf, rows in tree.reached(queries, rises, falls) for r in rows}
        assert all((leaf, r) in reached for r, leaf in own.items())


def test_chains_of_forms_end_at_the_root(spark):
    steps = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb", "aabbbbbb"]
    texts = [" ".join([w] * (3 * 2**i)) for i, w in enumerate(steps)]
    got = as_dict(spelling.spelling_forms(documents(spark, texts)))
    assert got == by_pairs(counted(enumerate(texts)))
    assert len({root for _, root, *_ in got.values()}) == 1


def test_tables_of_a_task_are_handed_on_when_full(spark):
    texts = ["berlin london madrid lisbon vienna prague"] * 4 + ["londen lundon"] * 3
    rows = spelling.vocabulary(documents(spark, texts), "doc_id", "text", most=3).collect()
    assert {r["word"]: r["n"] for r in rows} == counted(enumerate(texts))


def test_odd_rows_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    more = odd.unionByName(odd).unionByName(odd)
    assert as_dict(spelling.spelling_forms(more)) == by_pairs(counted(rows * 3))
    none = spelling.spelling_forms(odd.limit(0))
    assert none.collect() == []
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_one_edit_of_long_words():
    a = "xy" * 100_000
    assert spelling.one_edit(a, a + "x") and spelling.one_edit("z" + a, a)
    assert spelling.one_edit(a[:777] + a[778:], a) and spelling.one_edit(a[:9] + "q" + a[10:], a)
    assert not spelling.one_edit(a, a) and not spelling.one_edit(a, a + "xy")
    assert not spelling.one_edit(a, a[1:] + a[0])
