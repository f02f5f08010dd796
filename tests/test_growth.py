"""What a task holds, and what is stored, must not grow faster than the tables."""

from __future__ import annotations

import pytest
from invented import configured, flat_rows
from pyspark.sql import types as T

from dimloom.plans import model as m
from dimloom.plans import quality, run
from dimloom.plans import tables as t
from dimloom.sources import records
from dimloom.sources.flat import BROKEN
from workload import queries, roles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def model(spark, tmp_path):
    flat = flat_rows(spark, {}, {"visit_id": "v2", "patient_id": "p2"})
    return run.write_model(m.build_model(flat), str(tmp_path / "model"))


def test_larger_tables_are_shuffled_in_more_partitions(spark, monkeypatch):
    size = queries.input_bytes(spark, SF_DIR)
    with configured(spark, shuffle_partitions="8"):
        queries.open_tables(spark, SF_DIR)
        assert spark.conf.get(queries.SHUFFLE_PARTITIONS) == "8"  # small tables change nothing
        monkeypatch.setattr(queries, "INPUT_PER_SHUFFLE_PARTITION", size // 20)
        queries.open_tables(spark, SF_DIR)
        assert int(spark.conf.get(queries.SHUFFLE_PARTITIONS)) >= 20


@pytest.mark.parametrize("name", ["blank_keys_fact", "blank_keys_fk_nulls"])
def test_the_fact_alone_stores_the_columns_it_reads(spark, monkeypatch, name):
    stored, store = [], queries.landed

    def landed(frame):
        stored.append(frame.columns)
        return store(frame)

    monkeypatch.setattr(queries, "landed", landed)
    assert queries.QUERIES[name](spark, SF_DIR).count() > 0
    assert len(stored) == 1 and {"visit_id", "doctor_name", "lab_order_id"} <= set(stored[0])
    assert not {"patient_first_name", "prescription_drug_name"} & set(stored[0])


def test_landed_rows_are_packed_tightly(spark):
    landed = queries.landed(roles.orders(roles.Tables(spark, SF_DIR)))
    assert all(name.endswith(".zstd.parquet") for name in landed.inputFiles())


def test_usage_is_counted_side_by_side(spark, tmp_path, monkeypatch, model):
    started, start = [], quality.side_by_side

    def side_by_side(session, *writes):
        started.append(len(writes))
        start(session, *writes)

    monkeypatch.setattr(quality, "side_by_side", side_by_side)
    quality.write_usage(model, str(tmp_path / "usage"))
    quality.add_usage(model, str(tmp_path / "kept"), "all")
    assert started == [len(t.PRIMARY_KEYS), len(t.PRIMARY_KEYS) + 1]


def test_export_starts_with_the_fact_and_its_check_stores_what_it_reads(
    spark, tmp_path, monkeypatch, model
):
    firsts, start = [], run.side_by_side

    def side_by_side(session, *writes):
        firsts.append(writes[0].args[0])
        start(session, *writes)

    monkeypatch.setattr(run, "side_by_side", side_by_side)
    monkeypatch.setattr(run, "scratch_path", lambda _, label: str(tmp_path / label))
    run.export_model(model, str(tmp_path / "csv"))
    report = {tuple(r) for r in run.validate_export(spark, str(tmp_path / "csv")).collect()}
    assert firsts[0] == t.FACT and firsts[1].endswith(t.FACT)
    stored = spark.read.parquet(str(tmp_path / "validated" / "DimPatient"))
    assert stored.columns == ["patient_id", "patient_status", BROKEN]
    assert {tuple(r) for r in quality.report(model).collect()} <= report


def test_lines_are_placed_by_a_short_name_of_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n"x\ny"\n')
    lines = records._lines(spark, str(tmp_path), ",")
    assert lines.schema["file"].dataType == T.LongType()
    read = records.read_records(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in read} == {("h", True), ('"x\ny"', False)}
