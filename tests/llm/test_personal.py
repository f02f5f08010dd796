"""Personal data: the patterns as they are given, and what bootstrapping adds."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from dimloom.llm import personal
from tests.llm.helpers import documents, odd_documents


def base(text: str) -> list[tuple[int, int, int]]:
    found = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(d) for d in re.findall("[0-9]", m.group())]
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])]
        if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.findall("[0-9]", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


PARTS = ["a", "@", ".", "b.c", "1", "23", "+", "-", " ", "(", ")", "4.5", "4111 1111 1111 1111", "é"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert personal.base_spans(text) == base(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+" * 200_000, "a@" * 100_000):
        personal.base_spans(text)


def calls(count: int, unknown: int) -> list[str]:
    rng = random.Random(1)
    known = [f"please{i} call me at +1 (212) 555-{1000 + i} today" for i in range(count)]
    others = [f"note{i} call me at 212.555.{2000 + i} thanks" for i in range(unknown)]
    # Words that stand before much else are no pattern, whatever follows them now and then.
    prose = [f"one of the +1 (212) 555-{3000 + i} and one of the {'tree' * 2}" for i in range(20)]
    prose += ["one of the stones one of the rivers " * 5 for _ in range(20)] + ["of the 1234567"]
    texts = known + others + prose
    rng.shuffle(texts)
    return texts


def test_patterns_find_unseen_identifiers(spark):
    texts = calls(30, 4)
    rows = {r["doc_id"]: r for r in personal.personal_data(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        spans = base(text)
        told = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert rows[i]["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert rows[i]["n_phone"] == len(spans)
        if text.startswith("note"):
            start = text.index("212.")
            assert rows[i]["spans"] == f"phone:{start}:{start + 12}"
        else:
            assert rows[i]["spans"] == told


def test_unseen_identifiers_in_the_shape_of_their_kind(spark):
    texts = [f"please{i} call me at +1 (212) 555-{1000 + i} today{i}" for i in range(30)]
    texts += [f"note{i} Phone: +1 (212) 555-{4000 + i} n{i}" for i in range(30)]
    texts += [f"k{i} write her under bob{i}@example.org now{i}" for i in range(30)]
    texts += [f"s{i} t{i} bob{i}@example.com wrote u{i}" for i in range(30)]
    unseen = [
        ("call me at ", "(212) 555-2000", "phone"),
        ("call me at ", "212 555 2000", "phone"),
        ("call me at ", "555 12 34 56", "phone"),
        ("call me at ", "123-456-789", "phone"),
        ("changing Phone: ", "212 555 2001", "phone"),
        ("write her under ", "jane at example dot org", "email"),
        ("", "jane (at) example.net", "email"),
        ("w\u00e9 call me at ", "9" * 70, "phone"),
    ]
    first = len(texts)
    after = ["" if before else " wrote" for before, _, _ in unseen]
    texts += [f"x{i} {before}{value}{after[i]}" for i, (before, value, _) in enumerate(unseen)]
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r["spans"] for r in personal.personal_data(docs).collect()}
    masked = {r["doc_id"]: r["text"] for r in personal.masked(docs).collect()}
    for i, (before, value, kind) in enumerate(unseen):
        start = texts[first + i].index(value)
        assert f"{kind}:{start}:{start + len(value)}" in rows[first + i].split(","), value
        assert masked[first + i] == f"x{i} {before}<{kind.upper()}>{after[i]}"


def test_blocks_mask_the_spans_of_the_original_text(spark, monkeypatch):
    texts = [f"a{i} joe{i}@example.com phone +1 (212) 555-{1000 + i} b{i}" for i in range(20)]
    texts += [f"c{i} kim{i}@example.com phone 212.555.{2000 + i} d{i}" for i in range(4)]
    texts += [f"e{i} one phone of {i}" for i in range(40)]
    docs = documents(spark, texts)
    for block in (personal.BLOCK, 1):
        monkeypatch.setattr(personal, "BLOCK", block)
        rows = {r["doc_id"]: r["text"] for r in personal.masked(docs).collect()}
        assert [rows[20 + i] for i in range(4)] == [f"c{i} <EMAIL> phone <PHONE> d{i}" for i in range(4)]


def test_contexts_are_those_of_the_whole_text():
    for word in ("w" * 300, "\u6f22\u5b57" * 100, "short"):
        text = f"\u00e9 {word} number 212.555.2000 x"
        start = text.index("212")
        found = personal.contexts([text], [(0, start, start + 12)])[0]
        assert len(found) == 3 and set(found) <= set(personal.all_contexts([text.encode()]).tolist())
        other = text.replace(word, word + "y")
        assert personal.contexts([other], [(0, start + 1, start + 13)])[0][0] != found[0]


def test_too_few_seeds_teach_nothing(spark):
    texts = calls(personal.LEAST_KNOWN - 1, 4)
    rows = personal.personal_data(documents(spark, texts)).collect()
    assert all(not r["spans"] for r in rows if texts[r["doc_id"]].startswith("note"))


def test_masking_with_one_and_with_several_blocks_of_patterns(spark, monkeypatch):
    texts = calls(30, 2) + [f"mail to bob{i}@example.org or 10.0.0.{i}" for i in range(3)] + [None]
    texts += [f"sent from host 10.1.1.{i} ok" for i in range(9)] + ["x sent from host srv0001.local"]
    docs = documents(spark, texts)
    want = None
    for block in (personal.BLOCK, 1):
        monkeypatch.setattr(personal, "BLOCK", block)
        rows = {r["doc_id"]: r for r in personal.masked(docs).collect()}
        assert len(rows) == len(texts)
        found = {i: r["text"] for i, r in rows.items()}
        assert want is None or found == want
        want = found
    for i, text in enumerate(texts):
        if text is None:
            assert want[i] is None and rows[i]["n_chars"] is None
            continue
        assert rows[i]["n_chars"] == len(want[i])
        if text.startswith("mail"):
            assert want[i] == "mail to <EMAIL> or <IP>"
        if text.startswith("note"):
            assert want[i].endswith("call me at <PHONE> thanks")
        if not base(text) and not text.startswith(("note", "x sent")):
            assert want[i] == text


def test_overlapping_spans_become_one_mark():
    assert personal.masked_text("ab 123456 cd", [(3, 2, 9), (5, 3, 9)]) == "ab <CARD> cd"


def test_odd_rows_and_empty_tables(spark):
    odd = odd_documents(spark)
    assert personal.personal_data(odd).count() == odd.count()
    assert personal.personal_data(odd.limit(0)).collect() == []
    masked = personal.masked(odd)
    assert masked.schema == odd.schema and masked.exceptAll(odd).isEmpty()


def bootstrapped(texts: list[str]) -> list[set[tuple[int, int, int]]]:
    """Spans that patterns add to each text, by plain loops over the graph."""
    graph: dict[int, dict[int, set[int]]] = {}  # context -> token -> kinds and shapes
    places: Counter[int] = Counter()
    spans = []
    for text in texts:
        own = personal.base_spans(text)
        some = [*own, *personal.candidate_tokens(text, own)]
        near = personal.contexts([text], [(0, a, e) for a, _, e in some])
        spans.append(list(zip(some, near, strict=True)))
        for (start, kind, end), contexts in spans[-1]:
            token = personal.token_hash(text[start:end].encode())
            for context in contexts:
                graph.setdefault(context, {}).setdefault(token, set()).add(kind)
                places[context] += 1
    everywhere = Counter(personal.all_contexts([t.encode() for t in texts]).tolist())
    seeds = {(t, k): 1.0 for some in graph.values() for t, ks in some.items() for k in ks if k >= 0}
    known, trusted = dict(seeds), {}
    while True:
        new = {}
        for context, tokens in graph.items():
            for kind in range(4):
                scores = [known[t, kind] for t in tokens if (t, kind) in known]
                sure = sum(scores) / len(tokens)
                often = places[context] >= personal.LEAST_SHARE * everywhere[context]
                enough = len(scores) >= personal.LEAST_KNOWN and sure >= personal.LEAST_CONFIDENCE
                if enough and often and (context, kind) not in trusted:
                    new[context, kind] = sure
        if not new:
            break
        trusted |= new
        known = dict(seeds)
        for (context, kind), sure in trusted.items():
            for token, kinds in graph[context].items():
                if any(kind in personal.FITS[k] for k in kinds if k < 0):
                    known[token, kind] = max(known.get((token, kind), 0.0), sure)
    found: list[set[tuple[int, int, int]]] = []
    for some in spans:
        found.append(set())
        for (start, shape, end), contexts in some:
            fit = [
                (sure, kind)
                for context in contexts
                for kind in range(4)
                if shape < 0 and kind in personal.FITS[shape]
                if (sure := trusted.get((context, kind))) is not None
            ]
            if fit:
                found[-1].add((start, max(fit)[1], end))
    return found


def chained(rounds: int) -> list[str]:
    """Texts whose patterns are each learnt from the identifiers that the one before found."""
    rng = random.Random(4)
    texts, number = [], 2000

    def phone(known: bool) -> str:
        nonlocal number
        number += 1
        return f"+1 (212) 555-{number}" if known else f"212.555.{number}"

    before = [phone(True) for _ in range(8)]
    for step in range(rounds):
        fresh = [phone(False) for _ in range(8)]
        # The step's words precede eight known ones, and one in ten that are new.
        texts += [f"x{rng.random()} word{chr(97 + step)} {p} y{rng.random()}" for p in before * 4]
        texts += [f"x{rng.random()} word{chr(97 + step)} {p} y{rng.random()}" for p in fresh[:1]]
        before = [*before[1:], fresh[0]]
    texts += [f"word{chr(97 + i % rounds)} and more {i}" for i in range(20)]
    texts += [f"total 4.{i}77.1234 due by {i}" for i in range(30)] + ["", "no digits at all"]
    rng.shuffle(texts)
    return texts


def test_patterns_equal_plain_loops_over_the_graph(spark):
    for texts, least in ((calls(30, 4), 4), (chained(7), 6)):
        want = bootstrapped(texts)
        rows = personal.found_spans(documents(spark, texts)).collect()
        added = 0
        for row in rows:
            base_ones = {tuple(s) for s in row["base"]}
            got = {tuple(s) for s in row["spans"]} - base_ones
            assert got == want[row["doc_id"]], texts[row["doc_id"]]
            added += len(got)
        assert added >= least
