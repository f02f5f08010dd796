"""Small frames with the rows that are easy to get wrong."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[str | None], first_id: int = 0) -> DataFrame:
    rows = [
        (first_id + i, t, "en", "s", len(t) if t is not None else None)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and blank texts, repeated rows and ids, and further columns
    whose names the operators use themselves."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "s", 35),
        (1, "alpha beta gamma delta epsilon zeta", "en", "s", 35),
        (1, "another text under the same id", None, None, None),
        (None, None, None, None, None),
        (None, "a text without an id, password=abcdefgh1", "en", "s", 9),
        (2, "", "", "", 0),
        (3, " \t\n ", "de", "s", 4),
        (4, None, "de", "s", None),
        (5, "x" * 20_000, "de", "s", 20_000),
    ]
    wide = ", _score double, row long, node long, n long, key long, score double, _text string"
    values = [(*row, None, 7, 7, 7, 7, 0.5, "z") for row in rows]
    return spark.createDataFrame(values, COLUMNS + wide)


def words(rng: random.Random, count: int, vocabulary: int = 3000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def edited(rng: random.Random, base: list[str], changes: int) -> list[str]:
    copy = list(base)
    for _ in range(changes):
        copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
    return copy
