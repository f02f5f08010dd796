"""A whole run: flat text in, eleven tables and a quality report out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.functions.cells import ACTIVE_AFTER
from dimloom.plans import quality
from dimloom.plans.jobs import side_by_side
from dimloom.plans.model import build_model, published
from dimloom.plans.tables import COLUMNS, FACT, LINKS, PRIMARY_KEYS
from dimloom.scratch import scratch_path, store
from dimloom.sources.flat import BROKEN, cell_rejects, land_flat, read_flat
from dimloom.sources.tables import read_csv_table, read_model, spread, write_csv, write_parquet


def _fact_first(names: Iterable[str]) -> list[str]:
    return sorted(names, key=lambda name: name != FACT)  # it takes longest


def write_model(model: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write every table as Parquet below ``folder`` and read it back, sizes now known."""
    spark = model[FACT].sparkSession
    side_by_side(
        spark,
        *(partial(write_parquet, model[n], f"{folder}/{n}") for n in _fact_first(model)),
    )
    return dict(read_model(spark, folder))


def export_model(
    model: Mapping[str, DataFrame],
    folder: str,
    fact_by_month: bool = False,
    compression: str = "none",
) -> None:
    """Write the published text layout, one directory of part files per table."""

    def export(name: str) -> None:
        if name == FACT and fact_by_month:
            export_fact_by_month(model[name], f"{folder}/{name}", compression=compression)
        else:
            table = published(name, model[name])
            write_csv(table, f"{folder}/{name}", compression=compression)

    side_by_side(model[FACT].sparkSession, *(partial(export, n) for n in _fact_first(model)))


def export_fact_by_month(
    fact: DataFrame, folder: str, keep_other_months: bool = False, compression: str = "none"
) -> None:
    """Write the fact as text, a directory for each month it has.

    With ``keep_other_months``, what the folder has of other months stays, so a later run over
    some months replaces just those.
    """
    # Gathered by a number and as moments, which are shorter to shuffle than their texts.
    number = F.year("visit_datetime") * 12 + F.month("visit_datetime")
    gathered = spread(fact.withColumn("_month", number), ["_month"]).drop("_month")
    by_month = gathered.withColumn("visit_month", F.date_format("visit_datetime", "yyyy-MM"))
    table = published(FACT, by_month)
    write_csv(table, folder, ["visit_month"], not keep_other_months, compression, gathered=True)


def normalize(
    spark: SparkSession,
    flat_path: str,
    folder: str,
    separator: str = ",",
    multiline: bool = False,
    keep_broken: bool = True,
    active_after: dt.date = ACTIVE_AFTER,
    partitions: int | None = None,
    compression: str = "none",
) -> dict[str, DataFrame]:
    """Text to model: landed once, built, written as Parquet and CSV, checked.

    Below ``folder``: ``landed``, ``model/<table>``, ``csv/<table>``, and the four reports
    ``broken_rows``, ``cell_rejects``, ``input_keys`` and ``quality``. The last also has the
    number of torn rows and of those left out. ``compression`` packs the CSV tables. Returns
    the written tables.
    """
    text = read_flat(spark, flat_path, separator, multiline)
    flat, broken = land_flat(text, f"{folder}/landed", keep_broken, partitions)
    model = write_model(build_model(flat, active_after), f"{folder}/model")
    reports = {
        "broken_rows": broken,
        "cell_rejects": cell_rejects(flat),
        "input_keys": quality.input_profile(flat),
        "quality": quality.report(model).unionByName(
            quality.torn_rows({"landed": broken}, left_out=not keep_broken)
        ),
    }
    side_by_side(
        spark,
        lambda: export_model(model, f"{folder}/csv", compression=compression),
        *(partial(write_parquet, report, f"{folder}/{name}") for name, report in reports.items()),
    )
    return model


def _checked(name: str) -> set[str]:
    """The columns of a table that the quality report reads."""
    links = {c for link in LINKS for c in link.columns} if name == FACT else set()
    return {*PRIMARY_KEYS[name], *links, quality.STATUSES}


def validate_export(
    spark: SparkSession, folder: str, suffix: str = "", multiline: bool = False
) -> DataFrame:
    """The quality report of exported text tables, their keys compared as text.

    A table is the directory or file ``<folder>/<table><suffix>``. Rows with a wrong number of
    fields are counted per table; the cells that were read of them are checked as well. Each
    text is parsed once, whole, into Parquet of the columns that the checks read.
    """
    landed = scratch_path(spark, "validated")
    texts = {}
    for name, columns in COLUMNS.items():
        text = read_csv_table(spark, f"{folder}/{name}{suffix}", columns, multiline)
        texts[name] = text.select(*(c for c in columns if c in _checked(name)), BROKEN)
    side_by_side(
        spark, *(partial(store, f"{landed}/{n}", texts[n]) for n in _fact_first(texts))
    )
    tables = {
        name: spark.read.schema(text.schema).parquet(f"{landed}/{name}")
        for name, text in texts.items()
    }
    torn = {
        name: table.where(F.col(BROKEN).isNotNull()).select(BROKEN)
        for name, table in tables.items()
    }
    whole = {name: table.drop(BROKEN) for name, table in tables.items()}
    return quality.report(whole).unionByName(quality.torn_rows(torn))
