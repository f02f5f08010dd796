"""Expressions over single text cells.

Every expression is built in (no Python worker) and none of them raises under ANSI mode:
text that cannot be read becomes null, and ``unreadable`` tells those nulls from missing text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats, amount type, cut-off day and labels of the published tables.
MICROSECOND_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
DAY_PATTERN = "yyyy-MM-dd"
AMOUNT_TYPE = "decimal(10,2)"
ACTIVE_AFTER = dt.date(2021, 12, 31)
ACTIVE, INACTIVE = "Active", "Inactive"

# What a time of a visit or billing may look like.
MOMENT_PATTERNS = (MICROSECOND_PATTERN, SECOND_PATTERN, DAY_PATTERN)
# The bytes of a text without a sign that each pattern reads: one to six digits of a fraction.
LENGTHS = {MICROSECOND_PATTERN: (21, 26), SECOND_PATTERN: (19, 19), DAY_PATTERN: (10, 10)}
WHITE_SPACE = " \t\n\r\f\v"


def is_blank(cell: Column) -> Column:
    """True for null, empty and white-space-only text; never null itself."""
    return cell.isNull() | (F.btrim(cell, F.lit(WHITE_SPACE)) == "")


def filled(cell: Column) -> Column:
    """The cell, or null if it is blank: the one rule for every key.

    As ``is_blank`` has it, without a test for null, which no comparison is true for: a row has so
    many keys that Java would not compile the code for all of them.
    """
    return F.when(F.btrim(cell, F.lit(WHITE_SPACE)) != "", cell)


def parse_timestamp(cell: Column, *patterns: str) -> Column:
    """Text to a zone-free timestamp by the first of ``patterns`` that reads it, or by Spark's own
    rules if there are none.

    A pattern that fails costs many times one that works, so a text goes to the one pattern its
    length allows, and to none if no pattern reads that length. Only years with a sign may be
    longer; for them, and for patterns of unknown length, all are tried in turn. Years of more
    than five digits are not read, as the largest of them raise an error in Spark.
    """
    signed = cell.startswith("+") | cell.startswith("-")
    usual = ~signed | cell.rlike(r"^[+-]\d{1,5}-")

    def tried(*some: str) -> Column:
        return F.coalesce(*(F.try_to_timestamp(cell, F.lit(p)) for p in some))

    if not patterns:
        parsed = F.when(usual, F.try_to_timestamp(cell))
    elif len(patterns) == 1 or not set(patterns) <= set(LENGTHS):
        parsed = F.when(usual, tried(*patterns))
    else:
        parsed = F.when(signed, F.when(usual, tried(*patterns)))
        for pattern in patterns:
            parsed = parsed.when(F.octet_length(cell).between(*LENGTHS[pattern]), tried(pattern))
    return parsed.cast("timestamp_ntz")


def parse_amount(cell: Column) -> Column:
    """Text to money, rounded half up; too many digits or other text give null."""
    return cell.try_cast(AMOUNT_TYPE)


def parse_days(cell: Column) -> Column:
    """Text to a whole number of days.

    A cast that fails costs twenty times one that works, so text of another shape is kept from
    it: a column full of ``n/a`` must not slow the whole table down.
    """
    could_be_whole = cell.rlike(r"^\W*0*\d{1,10}\W*$")
    return F.when(could_be_whole, cell.try_cast("int"))


def seconds_text(moment: Column) -> Column:
    """Timestamp as text cut (not rounded) to whole seconds."""
    return F.date_format(moment, SECOND_PATTERN)


def activity_status(last_visit: Column, active_after: dt.date = ACTIVE_AFTER) -> Column:
    """Active only for a last visit strictly after the cut-off day; no visit means inactive."""
    is_active = last_visit.cast("date") > F.lit(active_after)
    return F.when(is_active, ACTIVE).otherwise(INACTIVE)


def unreadable(cell: Column, parsed: Column) -> Column:
    """True where there is text but parsing it gave nothing."""
    return ~is_blank(cell) & parsed.isNull()
