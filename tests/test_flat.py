from __future__ import annotations

import pytest
from invented import BASE, flat_rows, rows

from dimloom.sources.flat import FLAT_COLUMNS, cell_rejects, land_flat, read_flat
from dimloom.sources.tables import read_csv_table, write_csv


def write_text(path, lines):
    path.mkdir()
    (path / "input.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def line(**cells):
    values = {**BASE, "doctor_department": "Eyes", **cells}
    return ",".join(values.get(c, "") for c in FLAT_COLUMNS)


def test_forty_seven_text_columns_under_their_names_in_any_order(spark, tmp_path):
    assert len(FLAT_COLUMNS) == len(set(FLAT_COLUMNS)) == 47
    header = ["extra", *reversed(FLAT_COLUMNS)]
    cells = ["?", *(f"<{c}>" for c in reversed(FLAT_COLUMNS))]
    flat = read_flat(spark, write_text(tmp_path / "in", [",".join(header), ",".join(cells)]))
    assert {f.dataType.simpleString() for f in flat.schema} == {"string"}
    assert flat.select(*FLAT_COLUMNS).collect() == [tuple(f"<{c}>" for c in FLAT_COLUMNS)]


def test_header_names_match_without_regard_to_case(spark, tmp_path):
    text = [",".join(c.upper() for c in FLAT_COLUMNS), line()]
    flat = read_flat(spark, write_text(tmp_path / "in", text))
    assert flat.columns[:-1] == list(FLAT_COLUMNS) and flat.first()["visit_id"] == "v1"
    # Spark itself numbers names it sees twice, so none of the two is there any more.
    twice = [",".join([*FLAT_COLUMNS, "VISIT_ID"]), line() + ",v2"]
    with pytest.raises(ValueError, match="visit_id"):
        read_flat(spark, write_text(tmp_path / "twice", twice))


def test_missing_column_is_named(spark, tmp_path):
    path = write_text(tmp_path / "in", [",".join(c for c in FLAT_COLUMNS if c != "room_number")])
    with pytest.raises(ValueError, match="room_number"):
        read_flat(spark, path)


def test_files_with_different_headers_fail_instead_of_shifting(spark, tmp_path):
    path = tmp_path / "in"
    write_text(path, [",".join(FLAT_COLUMNS), line()])
    other = [",".join(reversed(FLAT_COLUMNS)), line()]
    (path / "other.csv").write_text("\n".join(other) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_flat(spark, str(path)).collect()


def test_other_separator(spark, tmp_path):
    text = [";".join(FLAT_COLUMNS), ";".join(f"{i},5" for i, _ in enumerate(FLAT_COLUMNS))]
    flat = read_flat(spark, write_text(tmp_path / "in", text), separator=";")
    assert flat.first()["patient_id"] == "0,5"


def test_quotes_separators_and_outer_blanks_survive_a_round_trip(spark, tmp_path):
    cells = {"patient_first_name": ' "Q", x ', "doctor_department": "a, b", "room_number": "\\"}
    write_csv(flat_rows(spark, cells), str(tmp_path / "csv"))
    read = read_flat(spark, str(tmp_path / "csv"))
    assert rows(read, *cells) == {tuple(cells.values())}


def test_blank_text_comes_back_as_null_and_spaces_stay(spark, tmp_path):
    write_csv(flat_rows(spark, {"lab_order_id": "", "lab_name": "  "}), str(tmp_path / "csv"))
    read = read_flat(spark, str(tmp_path / "csv"))
    assert rows(read, "lab_order_id", "lab_name") == {(None, "  ")}


def test_line_breaks_in_fields_need_multiline(spark, tmp_path):
    broken = flat_rows(
        spark,
        {"visit_id": "v1", "patient_address_line1": "one\ntwo"},
        {"visit_id": "v2"},
    )
    write_csv(broken.coalesce(1), str(tmp_path / "csv"))
    whole = read_flat(spark, str(tmp_path / "csv"), multiline=True)
    assert rows(whole, "visit_id", "patient_address_line1") == {("v1", "one\ntwo"), ("v2", None)}
    good, rejected = land_flat(
        read_flat(spark, str(tmp_path / "csv")), str(tmp_path / "landed"), keep_broken=False
    )
    assert rows(good, "visit_id") == {("v2",)}
    assert rejected.count() == 2  # both halves of the torn row, as raw text


def test_broken_rows_are_found_beside_columns_that_are_not_read(spark, tmp_path):
    text = [",".join(["extra", *FLAT_COLUMNS, "other"]), "e," + line() + ",o", line(), "e,f"]
    flat = read_flat(spark, write_text(tmp_path / "in", text))
    good, broken = land_flat(flat, str(tmp_path / "landed"), keep_broken=False)
    assert rows(good, "visit_id", "room_number") == {("v1", "101")}
    assert rows(broken) == {(line(),), ("e,f",)}


def test_unusual_text_survives_a_round_trip(spark, tmp_path):
    text = ["a\rb", "a\r\nb", '"', '""', 'a"b', "a\\", '\\"', "#x", "\ta\t", "\u2028", "'", "null"]
    written = flat_rows(
        spark, *({"visit_id": str(i), "patient_city": cell} for i, cell in enumerate(text))
    )
    write_csv(written, str(tmp_path / "csv"))
    read = read_flat(spark, str(tmp_path / "csv"), multiline=True)
    assert rows(read, "visit_id", "patient_city") == {(str(i), c) for i, c in enumerate(text)}


def test_rows_with_too_few_or_many_fields_are_kept_unless_told_otherwise(spark, tmp_path):
    text = [",".join(FLAT_COLUMNS), line(), line() + ",more", "only,three,fields"]
    flat = read_flat(spark, write_text(tmp_path / "in", text))
    good, broken = land_flat(flat, str(tmp_path / "landed"), keep_broken=False)
    assert good.count() == 1
    assert rows(broken) == {(line() + ",more",), ("only,three,fields",)}
    kept, broken = land_flat(flat, str(tmp_path / "kept"), partitions=3)
    assert (kept.count(), broken.count()) == (3, 2)
    assert ("only", "three", "fields", None) in rows(kept, *FLAT_COLUMNS[:4])


def test_header_alone_gives_no_rows(spark, tmp_path):
    flat = read_flat(spark, write_text(tmp_path / "in", [",".join(FLAT_COLUMNS)]))
    good, broken = land_flat(flat, str(tmp_path / "landed"))
    assert good.count() == broken.count() == 0


def test_empty_table_still_writes_its_header(spark, tmp_path):
    write_csv(flat_rows(spark, {}).limit(0), str(tmp_path / "csv"))
    assert read_csv_table(spark, str(tmp_path / "csv"), FLAT_COLUMNS).count() == 0
    assert read_flat(spark, str(tmp_path / "csv")).count() == 0


def test_table_reader_rejects_another_header(spark, tmp_path):
    write_csv(flat_rows(spark, {}).select("visit_id", "visit_type"), str(tmp_path / "csv"))
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, str(tmp_path / "csv"), ["visit_type", "visit_id"]).collect()


def test_unreadable_cells_are_listed_and_missing_ones_are_not(spark):
    flat = flat_rows(
        spark,
        {"visit_id": "v1", "visit_datetime": "06.05.2023", "billing_total_charge": "abc"},
        {"visit_id": "v2", "visit_datetime": "  ", "billing_total_charge": None},
        {"visit_id": "v3", "lab_result_date": "2023-05-06", "prescription_duration_days": "1.5"},
        {"visit_id": "v4", "billing_total_charge": "12345678901", "billing_date": "soon"},
        {"visit_id": "v5", "visit_datetime": "2023-05-06", "billing_date": "2023-05-06 07:08:09"},
    )
    assert rows(cell_rejects(flat)) == {
        ("v1", "visit_datetime", "06.05.2023", "not a timestamp"),
        ("v1", "billing_total_charge", "abc", "not an amount"),
        ("v3", "prescription_duration_days", "1.5", "not a whole number"),
        ("v4", "billing_total_charge", "12345678901", "not an amount"),
        ("v4", "billing_date", "soon", "not a timestamp"),
    }


def test_line_breaks_are_read_by_several_tasks_with_every_header_checked(spark, tmp_path):
    many = [{"visit_id": f"v{i}", "patient_address_line1": f"{i}\n, \"q\"\n"} for i in range(400)]
    write_csv(flat_rows(spark, *many).repartition(3), str(tmp_path / "csv"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        read = read_flat(spark, str(tmp_path / "csv"), multiline=True)
        want = {(c["visit_id"], c["patient_address_line1"]) for c in many}
        assert read.count() == 400 and rows(read, "visit_id", "patient_address_line1") == want
        good, broken = land_flat(read, str(tmp_path / "landed"), keep_broken=False)
        assert (good.count(), broken.count()) == (400, 0)
        (tmp_path / "csv" / "other.csv").write_text(",".join(reversed(FLAT_COLUMNS)) + "\n" + line())
        with pytest.raises(Exception, match="(?i)header"):
            read_flat(spark, str(tmp_path / "csv"), multiline=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_torn_records_of_several_lines_are_reported_whole(spark, tmp_path):
    text = [",".join(FLAT_COLUMNS).upper(), line(), 'x,"two\nlines"', line(room_number='"1\n2"') + ",more"]
    read = read_flat(spark, write_text(tmp_path / "in", text), multiline=True)
    good, broken = land_flat(read, str(tmp_path / "landed"), keep_broken=False)
    assert good.count() == 1
    assert rows(broken) == {('x,"two\nlines"',), (line(room_number='"1\n2"') + ",more",)}
