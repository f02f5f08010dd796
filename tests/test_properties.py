"""Operators against brute force on small random tables."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from invented import rows

from dimloom.operators import checks, dense_ids, one_per_key

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
words = st.sampled_from([None, "", " ", "a", "A", "ab", "b", "ü", "10", "9"])
table = st.lists(st.tuples(words, words, st.none() | st.integers(-3, 3)), max_size=40)
SCHEMA = "a string, b string, n int"


def lowest_none(value):
    """Order of Spark: nulls first, text by its bytes."""
    if value is None:
        return (0, b"")
    return (1, value.encode() if isinstance(value, str) else value)


def by(record):
    return tuple(lowest_none(v) for v in record)


@few
@given(table)
def test_survivor_is_the_greatest_row_of_its_key(spark, data):
    best = {}
    for a, b, n in data:
        if a not in best or by((n, b)) > by(best[a]):
            best[a] = (n, b)
    got = rows(one_per_key(spark.createDataFrame(data, SCHEMA), ["a"], ["n"]), "a", "n", "b")
    assert got == {(a, *rest) for a, rest in best.items()}


@few
@given(table)
def test_ids_are_positions_in_the_order_of_all_keys(spark, data):
    expected = sorted({(a, b) for a, b, _ in data}, key=by)
    got = rows(dense_ids(spark.createDataFrame(data, SCHEMA), ["a", "b"], "id"), "id", "a", "b")
    assert got == {(i, *pair) for i, pair in enumerate(expected, 1)}


@few
@given(table, table)
@pytest.mark.parametrize("columns", [["a"], ["a", "b"]])
def test_link_numbers_are_those_of_the_joined_rows(spark, columns, fact, dimension):
    def part(value):
        return None if isinstance(value, str) and not value.strip() else value

    def keys(data):
        return [tuple(part(dict(zip("abn", r, strict=True))[c]) for c in columns) for r in data]

    used, held = keys(fact), Counter(keys(dimension))
    empty = [k for k in used if None in k]
    filled = [k for k in used if None not in k]
    orphans = [k for k in filled if k not in held]
    frames = (spark.createDataFrame(data, SCHEMA) for data in (fact, dimension))
    left, right = frames
    usage = {"link": checks.key_usage(right, columns, left, columns)}
    got = checks.usage_profile(usage).first().asDict()
    got.pop("label")
    assert got == {
        "row_count": len(dimension),
        "null_rows": sum(n for k, n in held.items() if None in k),
        "duplicate_keys": sum(n > 1 for n in held.values()),
        "empty_links": len(empty),
        "orphan_keys": len(set(orphans)),
        "orphan_rows": len(orphans),
        "unused_keys": sum(None in k or k not in filled for k in held),
        "rows_before": len(fact),
        "rows_after": len(empty) + sum(max(held[k], 1) for k in filled),
    }
