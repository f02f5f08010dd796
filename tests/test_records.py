"""Cutting records at line breaks outside quotes, against Spark's own multi-line reader."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from invented import plan
from pyspark.sql import functions as F

from dimloom.sources.flat import CSV_OPTIONS
from dimloom.sources.records import ends_inside, read_records

COLUMNS = ["a", "b", "c"]


def quoted(cell: str) -> str:
    return '"' + cell.replace('"', '""') + '"'


def random_text(rng: random.Random, rows: int, separator: str = ",", end: str = "\n") -> str:
    parts = ["x", "word", '"', '""', "\n", separator, " ", "é", "1", "\n\n", f'"{separator}"', "'"]

    def cell() -> str:
        if rng.random() < 0.5:  # unquoted, a quote inside is just a character
            return rng.choice(["", "x", "plain text", 'in"ch', "5'6", "end\""])
        return quoted("".join(rng.choices(parts, k=rng.randint(0, 8))))

    lines = [separator.join(COLUMNS)]
    lines += [separator.join([f"r{i}", cell(), cell()]) for i in range(rows)]
    return end.join(lines) + end


def by_spark(spark, path: str, separator: str = ","):
    reader = spark.read.options(**CSV_OPTIONS, sep=separator, multiLine=True)
    return [tuple(r) for r in reader.schema("a string, b string, c string").csv(path).collect()]


def by_records(spark, path: str, separator: str = ","):
    records = read_records(spark, path, separator).where(~F.col("is_first"))
    options = {**CSV_OPTIONS, "sep": separator, "multiLine": True, "header": False}
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    row = F.from_csv("record", "a string, b string, c string", options)
    return [tuple(r) for r in records.select(row.alias("row")).select("row.*").collect()]


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}
    yield lambda size: [spark.conf.set(name, str(size)) for name in names]
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", [40, 333, 1 << 20])
@pytest.mark.parametrize(("separator", "end"), [(",", "\n"), (";", "\r\n"), ("|", "\n")])
def test_equals_the_multi_line_reader(spark, tmp_path, small_splits, size, separator, end):
    rng = random.Random(size)
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text(random_text(rng, 150, separator, end), newline="")
    want = by_spark(spark, str(tmp_path), separator)
    assert len(want) == 300 and any("\n" in (cell or "") for row in want for cell in row)
    small_splits(size)
    got = by_records(spark, str(tmp_path), separator)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    (tmp_path / "big.csv").write_text(random_text(random.Random(1), 3000))
    small_splits(4000)
    text = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 10
    records = read_records(spark, str(tmp_path))
    assert records.count() == 3001 and records.where("is_first").count() == 1
    assert "Python" not in plan(records) and "Arrow" not in plan(records)


def test_a_record_over_many_splits_and_an_open_quote_at_the_end(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}, and ''" for i in range(300))
    text = f'a,b,c\n1,{quoted(long)},x\n2,"y",z\n\n3,"never closed\n4,5,6\n'
    (tmp_path / "in.csv").write_text(text)
    small_splits(100)
    found = sorted(r["record"] for r in read_records(spark, str(tmp_path)).collect())
    assert found == sorted(["a,b,c", f"1,{quoted(long)},x", '2,"y",z', '3,"never closed\n4,5,6'])


def test_empty_files_and_files_without_a_line_end(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "one.csv").write_text('a,"b\nc",d')
    found = read_records(spark, str(tmp_path)).collect()
    assert [(r["record"], r["is_first"]) for r in found] == [('a,"b\nc",d', True)]


def plainly(line: str, inside: bool) -> bool:
    """One character after the other."""
    at, begin = 0, not inside
    while at < len(line):
        char = line[at]
        if inside:
            if char == '"' and line[at + 1 : at + 2] == '"':
                at += 1
            elif char == '"':
                inside = begin = False
        elif char == '"' and begin:
            inside = True
        else:
            begin = char == ","
        at += 1
    return inside


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet='",ab', max_size=12), min_size=1, max_size=40))
def test_lines_end_as_read_by_the_character(spark, lines):
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    rows = frame.select("line", *ends_inside(F.col("line"), ",")).collect()
    for line, from_outside, from_inside in rows:
        assert from_outside == plainly(line, False), line
        assert from_inside == plainly(line, True), line
