"""What a run shuffles and stores, and how long that stays on disk."""

from __future__ import annotations

import os
import re
import time
from pathlib import Path

import pytest
from invented import configured, flat_rows, plan, rows
from pyspark.sql import functions as F

from dimloom import scratch
from dimloom.functions import cells
from dimloom.operators.keys import dense_ids_together, looked_up_by_broadcast
from dimloom.plans import model as m
from dimloom.plans import run
from dimloom.plans import tables as t
from dimloom.sources.tables import write_csv
from workload import queries

SF_DIR = "/root/testdata/sf0.001"


def ties(spark):
    """Records of three visits that differ in the texts of their dimensions alone."""
    names = ["Dr A", "Dr B", "", " ", None, "a", "B"]
    return flat_rows(
        spark,
        *({"doctor_name": a, "room_number": b} for a in names for b in names),
        *({"visit_id": "v2", "secondary_diagnosis_code": a, "secondary_diagnosis_desc": b}
          for a in names for b in names),
        *({"visit_id": "v3", "treatment_code": a, "primary_diagnosis_desc": b}
          for a in names for b in names),
    )


def test_ids_are_shuffled_in_place_of_texts(spark, tmp_path):
    ties(spark).write.parquet(str(tmp_path / "flat"))
    fact = m.build_model(spark.read.parquet(str(tmp_path / "flat")))[t.FACT]
    text = plan(fact)
    tree = text[: text.index("\n\n")]
    assert tree.rindex("WindowGroupLimit") < tree.index("BroadcastHashJoin")
    (shuffled,) = re.findall(r"Exchange\nInput \[\d+\]: (.*)\nArguments: hashpart.*visit_id", text)
    assert "provider_id" in shuffled and "location_id" in shuffled
    assert "doctor_name" not in shuffled and "room_number" not in shuffled


def test_the_survivor_is_the_same_by_ids_and_by_texts(spark, tmp_path):
    ties(spark).write.parquet(str(tmp_path / "flat"))
    flat = spark.read.parquet(str(tmp_path / "flat"))
    dimensions = m.dims_numbered(dict.fromkeys(t.PRIMARY_KEYS, flat))
    by_ids = m.fact_visit(flat, dimensions, in_order=True).collect()
    assert len(by_ids) == 3
    assert set(by_ids) == set(m.fact_visit(flat, dimensions).collect())


def test_the_code_that_looks_ids_up_is_short_enough_to_be_compiled(spark):
    """Java interprets a method of more than 8,000 bytes, which takes three times as long."""
    with configured(spark, autoBroadcastJoinThreshold="60000", adaptive_enabled="false"):
        fact = queries.build(queries.open_tables(spark, "/root/testdata/sf0.01"))[t.FACT]
        code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$")
        text = code.__getattr__("MODULE$").codegenString(fact._jdf.queryExecution().executedPlan())
    assert "SortMergeJoin" in text
    assert max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000


def test_each_dimension_is_known_by_its_own_size(spark):
    large = spark.range(20_000).select(F.uuid().alias("a"))
    small = spark.createDataFrame([("x",)], "b string")
    dimensions = dense_ids_together(
        {"l": (large, ["a"], "id"), "s": (small, ["b"], "id"), "e": (small.limit(0), ["b"], "id")}
    )
    assert [dimensions[n].count() for n in "lse"] == [20_000, 1, 0]
    with configured(spark, autoBroadcastJoinThreshold="100KB"):
        assert not looked_up_by_broadcast(dimensions["l"], ["a"], "id")
        assert looked_up_by_broadcast(dimensions["s"], ["b"], "id")
        assert looked_up_by_broadcast(dimensions["e"], ["b"], "id")


def test_a_filled_cell_is_one_that_is_not_blank(spark):
    texts = [None, "", " ", "\t\n\r\f\v ", "a", " a ", "0", "\u00a0"]
    frame = spark.createDataFrame([(x,) for x in texts], "c string")
    blank = cells.is_blank(F.col("c"))
    found = frame.select("c", blank.alias("blank"), cells.filled(F.col("c")).alias("filled"))
    for r in found.collect():
        assert r.filled == (None if r.blank else r.c)


def shuffle_files(spark) -> int:
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]
    return sum(
        name.startswith("shuffle_") for f in folders for _, _, names in os.walk(f) for name in names
    )


@pytest.mark.parametrize("kind", ["store", "csv"])
def test_what_a_write_shuffles_goes_with_it(spark, tmp_path, kind):
    before = spark.conf.get(scratch._FREED, None)
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with configured(spark, adaptive_enabled="true"):
        files = shuffle_files(spark)
        path = str(tmp_path / "t")
        scratch.store(path, frame) if kind == "store" else write_csv(frame, path)
        for _ in range(50):
            if shuffle_files(spark) <= files:
                break
            time.sleep(0.2)
        assert shuffle_files(spark) <= files
        assert frame.count() == 7  # and can be used again
    assert spark.conf.get(scratch._FREED, None) == before


def test_writes_side_by_side_leave_the_setting_as_it_was(spark):
    before = spark.conf.get(scratch._FREED, None)
    first, second = scratch.shuffles_freed(spark), scratch.shuffles_freed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(scratch._FREED) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(scratch._FREED, None) == before


@pytest.mark.parametrize("name", ["exported_quality", "exported_quality_torn", "fact_by_month"])
def test_exports_are_packed(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(queries, "scratch_path", lambda _, label: str(tmp_path / label))
    queries.QUERIES[name](spark, SF_DIR).count()
    texts = [p.name for p in Path(tmp_path, "csv").rglob("part-*")]
    assert any(name.endswith(".csv.gz") for name in texts)
    assert not any(name.endswith(".csv") for name in texts)


def test_stored_tables_are_packed_tightly(spark, tmp_path):
    model = run.write_model(m.build_model(flat_rows(spark, {})), str(tmp_path / "model"))
    for table in model.values():
        assert all(name.endswith(".zstd.parquet") for name in table.inputFiles())


def test_months_are_gathered_by_a_number(spark, tmp_path, monkeypatch):
    written = []

    def write(df, path, *rest, **options):
        written.append(plan(df))
        write_csv(df, path, *rest, **options)

    monkeypatch.setattr(run, "write_csv", write)
    model = m.build_model(flat_rows(spark, {}, {"visit_id": "v2", "visit_datetime": None}))
    run.export_fact_by_month(model[t.FACT], str(tmp_path / "fact"))
    text = written[0]
    assert re.search(r"Arguments: hashpartitioning\(_month#\d+, \d+\), REBALANCE", text)
    months = {p.name for p in Path(tmp_path, "fact").glob("visit_month=*")}
    assert months == {"visit_month=2023-05", "visit_month=__HIVE_DEFAULT_PARTITION__"}
    found = spark.read.csv(str(tmp_path / "fact"), header=True)
    assert rows(found, "visit_id", "visit_datetime") == {("v1", "2023-05-06 07:08:09"), ("v2", None)}
