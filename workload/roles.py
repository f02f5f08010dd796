"""The test tables in the roles of the flat input's subjects, every cell as text.

orders are insurance and billing records, customers patients, parts providers and
prescriptions, suppliers locations, events lab orders, and lines visits. The tables hold no
nulls or blanks, so some cells are made null or blank here by rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.functions.cells import MICROSECOND_PATTERN
from dimloom.sources.flat import FLAT_COLUMNS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Tables(dict):
    """The test tables of one folder, each opened on first use.

    The caller knows whether tables come in too few pieces for its cores, and then says into
    how many partitions the large ones are to be dealt.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: int | None = None) -> None:
        super().__init__()
        self.spark, self.sf_dir, self.partitions = spark, sf_dir, partitions

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self[name]

    def dealt(self, name: str) -> DataFrame:
        return self[name].repartition(self.partitions) if self.partitions else self[name]


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)").cast("string")


def _moment(column: str) -> Column:
    return F.date_format(column, MICROSECOND_PATTERN)


def _absent(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _order_cells() -> list[Column]:
    """Patient id, visit type, insurance and billing of an order."""
    paid = F.when(F.col("o_orderstatus") == "F", _money("o_totalprice")).when(
        F.col("o_orderstatus") == "O", "0.00"
    )
    return [
        _text("o_custkey").alias("patient_id"),
        F.col("o_orderpriority").alias("visit_type"),
        F.col("o_orderpriority").alias("insurance_id"),
        F.col("o_orderstatus").alias("insurance_payer_name"),
        _text("o_orderkey").alias("insurance_policy_number"),
        _absent("insurance_group_number"),
        F.col("o_orderpriority").alias("insurance_plan_type"),
        _text("o_orderkey").alias("billing_id"),
        _money("o_totalprice").alias("billing_total_charge"),
        paid.alias("billing_amount_paid"),
        _moment("o_orderdate").alias("billing_date"),
        F.col("o_orderstatus").alias("billing_payment_status"),
    ]


def _customer_cells() -> list[Column]:
    """The attributes of a patient; the region stands for the treatment, the segment for gender."""
    return [
        F.substring_index("c_name", "#", 1).alias("patient_first_name"),
        F.substring_index("c_name", "#", -1).alias("patient_last_name"),
        _absent("patient_date_of_birth"),
        F.col("c_mktsegment").alias("patient_gender"),
        F.col("c_name").alias("patient_address_line1"),
        _absent("patient_address_line2"),
        F.col("n_name").alias("patient_city"),
        F.col("r_name").alias("patient_state"),
        _text("c_nationkey").alias("patient_zip"),
        _absent("patient_phone"),
        _absent("patient_email"),
        _text("r_regionkey").alias("treatment_code"),
        F.col("r_name").alias("treatment_desc"),
    ]


def _part_cells() -> list[Column]:
    """A part as provider and as prescription; economy parts have no prescription id."""
    return [
        F.col("p_brand").alias("doctor_name"),
        F.col("p_type").alias("doctor_title"),
        _text("p_size").alias("doctor_department"),
        F.when(F.col("p_type") != "ECONOMY", _text("p_partkey")).alias("prescription_id"),
        F.col("p_name").alias("prescription_drug_name"),
        F.concat(_text("p_size"), F.lit("mg")).alias("prescription_dosage"),
        F.col("p_type").alias("prescription_frequency"),
        _text("p_size").alias("prescription_duration_days"),
    ]


def _supplier_cells() -> list[Column]:
    return [F.col("clinic_nation").alias("clinic_name"), F.col("s_name").alias("room_number")]


def _event_cells() -> list[Column]:
    """An event as lab order; errors have no id and sign-ups a blank one."""
    kind = F.col("event_type")
    order_id = F.when(kind == "signup", "").when(kind != "error", _text("event_id"))
    return [
        order_id.alias("lab_order_id"),
        kind.alias("lab_test_code"),
        _text("user_id").alias("lab_name"),
        _money("value").alias("lab_result_value"),
        F.col("props").alias("lab_result_units"),
        _moment("ts").alias("lab_result_date"),
    ]


def _line_cells() -> list[Column]:
    """A line as visit; lines returned as N have no secondary diagnosis."""
    diagnosed = F.col("l_returnflag") != "N"
    return [
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("visit_id"),
        _moment("l_shipdate").alias("visit_datetime"),
        F.col("l_returnflag").alias("primary_diagnosis_code"),
        F.col("l_linestatus").alias("primary_diagnosis_desc"),
        F.when(diagnosed, F.col("l_returnflag")).alias("secondary_diagnosis_code"),
        F.when(diagnosed, F.col("l_linestatus")).alias("secondary_diagnosis_desc"),
    ]


def _with_nation(customers: DataFrame, tables: Tables) -> DataFrame:
    return customers.join(
        tables["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).join(tables["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")


def _with_clinic_nation(suppliers: DataFrame, tables: Tables) -> DataFrame:
    nations = tables["nation"].select(
        F.col("n_nationkey").alias("clinic_nation_key"), F.col("n_name").alias("clinic_nation")
    )
    return suppliers.join(nations, F.col("s_nationkey") == F.col("clinic_nation_key"), "left")


def orders(tables: Tables) -> DataFrame:
    """Insurance and billing records, dated by their order."""
    dated = _moment("o_orderdate").alias("visit_datetime")
    return tables.dealt("orders").select(dated, *_order_cells())


def customers(tables: Tables) -> DataFrame:
    return _with_nation(tables["customer"], tables).select(
        _text("c_custkey").alias("patient_id"), *_customer_cells()
    )


def parts(tables: Tables) -> DataFrame:
    return tables["part"].select(*_part_cells())


def suppliers(tables: Tables) -> DataFrame:
    return _with_clinic_nation(tables["supplier"], tables).select(*_supplier_cells())


def events(tables: Tables) -> DataFrame:
    return tables.dealt("events").select(*_event_cells())


def lines(tables: Tables) -> DataFrame:
    return tables["lineitem"].select(*_line_cells())


def line_billing(tables: Tables) -> DataFrame:
    """Lines as billing records: several, in different states, under one billing id."""
    return tables.dealt("lineitem").select(
        _text("l_orderkey").alias("billing_id"),
        F.col("l_returnflag").alias("insurance_id"),
        _money("l_extendedprice").alias("billing_total_charge"),
        _money("l_quantity").alias("billing_amount_paid"),
        _moment("l_shipdate").alias("billing_date"),
        F.col("l_linestatus").alias("billing_payment_status"),
    )


def messy(tables: Tables) -> DataFrame:
    """Orders whose cells are spoilt in a way that depends on their priority and status."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    when = _moment("o_orderdate")
    charge, days = _money("o_totalprice"), _text("o_custkey")
    return tables.dealt("orders").select(
        _text("o_orderkey").alias("visit_id"),
        F.when(priority == "1-URGENT", when)
        .when(priority == "2-HIGH", F.substring(when, 1, 19))
        .when(priority == "3-MEDIUM", F.concat(F.lit("on "), when))
        .when(priority == "4-NOT SPECIFIED", "  ")
        .otherwise(F.concat(when, F.lit("7")))
        .alias("visit_datetime"),
        F.when(priority == "1-URGENT", when)
        .when(priority == "2-HIGH", F.substring(when, 1, 10))
        .when(priority == "3-MEDIUM", "soon")
        .when(priority == "5-LOW", F.substring(when, 1, 19))
        .alias("lab_result_date"),
        F.when(status == "F", charge)
        .when(status == "O", F.concat(F.lit("123456"), charge))
        .otherwise("n/a")
        .alias("billing_total_charge"),
        F.when(status == "F", F.concat(charge, F.lit("5")))
        .when(status == "O", "1e2")
        .alias("billing_amount_paid"),
        F.when(status == "F", days)
        .when(status == "O", F.concat(days, F.lit(".5")))
        .otherwise("")
        .alias("prescription_duration_days"),
    )


def _star(tables: Tables) -> DataFrame:
    """Lines with the tables they refer to, one plain table per join so that Spark knows the
    size of every side it may broadcast.

    Lines are by far the most rows, so they meet parts and suppliers while they are narrow, and
    orders bring their customers along. What follows joins by the order as well, and so needs no
    other shuffle of the wide rows, whichever tables are too large to broadcast.
    """
    lines = (
        tables.dealt("lineitem")
        .join(tables["part"], F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(tables["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    dated = tables["orders"].join(
        tables["customer"], F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return _with_clinic_nation(lines, tables).join(
        _with_nation(dated, tables), F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )


def _visit_cells() -> list[Column]:
    return [
        *_line_cells(),
        *_order_cells(),
        *_customer_cells(),
        *_part_cells(),
        *_supplier_cells(),
    ]


def visits(tables: Tables) -> DataFrame:
    """Lines with all natural keys of a visit. Lab orders are referred to by order number,
    which some events do not have, so there are real orphans."""
    return _star(tables).select(*_visit_cells(), _text("l_orderkey").alias("lab_order_id"))


def flat(tables: Tables) -> DataFrame:
    """The whole flat input: a visit's row repeats the attributes of all its subjects."""
    with_events = _star(tables).join(
        tables["events"], F.col("l_orderkey") == F.col("event_id"), "left"
    )
    return with_events.select(*_visit_cells(), *_event_cells())


def mixed_times(tables: Tables) -> DataFrame:
    """The flat input with times of microseconds, seconds and days."""

    def cut(cell: str, by: str) -> Column:
        last = F.right(F.col(by), F.lit(1)).cast("int") % 3
        return (
            F.when(last == 1, F.substring(cell, 1, 19))
            .when(last == 2, F.substring(cell, 1, 10))
            .otherwise(F.col(cell))
        )

    return flat(tables).withColumns(
        {
            "visit_datetime": cut("visit_datetime", "visit_id"),
            "billing_date": cut("billing_date", "billing_id"),
        }
    )


def blank_keys(tables: Tables) -> DataFrame:
    """The flat input with some keys missing, empty, or of blanks, a tab or a line break."""
    order = F.substring_index("visit_id", "-", 1).cast("long") % 50

    def blanked(key: str, first: int) -> Column:
        cell = F.when(order == first, F.lit(None).cast("string"))
        for i, blank in enumerate(("", "  ", "\t", " \n"), 1):
            cell = cell.when(order == first + i, blank)
        return cell.otherwise(F.col(key))

    keys = ("patient_id", "insurance_id", "billing_id", "visit_id")
    return flat(tables).withColumns({k: blanked(k, 10 * i) for i, k in enumerate(keys)})


def torn_lines(tables: Tables) -> DataFrame:
    """Orders as lines of text (columns file, is_header, value): whole ones, ones with few
    fields, with one field too many, and ones with a line break in the third field."""
    start = [_text("o_custkey"), F.concat(F.lit("n"), _text("o_orderkey"))]
    whole = _order_line(F.col("o_orderstatus"), ",")
    kind = F.col("o_orderkey") % 4
    torn = F.concat("o_orderstatus", F.lit("\nrest-"), _text("o_orderkey"))
    broken = F.concat_ws(",", *start, torn)
    value = (
        F.when(kind == 1, F.concat_ws(",", *start))
        .when(kind == 2, F.concat(whole, F.lit(",one more")))
        .when(kind == 3, broken)
        .otherwise(whole)
    )
    return _in_files(tables, value, ",")


def quoted_lines(tables: Tables, separator: str) -> DataFrame:
    """Orders as text (columns file, is_header, value): plain rows, ones with line breaks in a
    quoted field, ones with separators, quotes and empty lines in it, and ones of several lines
    with one field too many."""
    kind, key = F.col("o_orderkey") % 4, _text("o_orderkey")
    several = F.concat(F.lit('"'), "o_orderstatus", F.lit("\nrest-"), key, F.lit('"'))
    parts = [F.lit('"'), "o_orderstatus", F.lit(f'{separator}\n\n""'), key, F.lit(f'""{separator}"')]
    name = F.when(kind == 0, F.col("o_orderstatus")).when(kind == 2, F.concat(*parts))
    line = _order_line(name.otherwise(several), separator)
    value = F.when(kind == 3, F.concat(line, F.lit(f'{separator}"one\nmore"'))).otherwise(line)
    return _in_files(tables, value, separator)


def _order_line(last_name: Column, separator: str) -> Column:
    """An order as a whole row of text, with this cell as the patient's last name."""
    visit_at = FLAT_COLUMNS.index("visit_id")
    middle = F.lit(separator * (visit_at - 3))
    rest = F.lit(separator * (len(FLAT_COLUMNS) - visit_at - 1))
    first = [_text("o_custkey"), F.concat(F.lit("n"), _text("o_orderkey"))]
    return F.concat_ws(separator, *first, last_name, F.concat(middle, _text("o_orderkey"), rest))


def _in_files(tables: Tables, value: Column, separator: str) -> DataFrame:
    """Orders as lines dealt to files, each with a header."""
    # As many files as the table has partitions, so no task writes more as the table grows.
    files = max(1, tables["orders"].rdd.getNumPartitions())
    lines_of = tables["orders"].select(
        F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).cast("int").alias("file"),
        F.lit(False).alias("is_header"),
        value.alias("value"),
    )
    headers = tables.spark.range(files).select(
        F.col("id").cast("int").alias("file"),
        F.lit(True).alias("is_header"),
        F.lit(separator.join(FLAT_COLUMNS)).alias("value"),
    )
    return lines_of.unionByName(headers)


# The frame each table of the model is built from.
SOURCES = {
    "DimPatient": customers,
    "DimInsurance": orders,
    "DimBilling": orders,
    "DimProvider": parts,
    "DimLocation": suppliers,
    "DimPrimaryDiagnosis": lines,
    "DimSecondaryDiagnosis": lines,
    "DimTreatment": customers,
    "DimPrescription": parts,
    "DimLabOrder": events,
    "FactVisit": visits,
}


def sources(tables: Tables) -> dict[str, DataFrame]:
    frames = {source: source(tables) for source in set(SOURCES.values())}
    return {name: frames[source] for name, source in SOURCES.items()}
