"""Column expressions used by the builders."""

from dimloom.functions.cells import (
    activity_status,
    is_blank,
    parse_amount,
    parse_days,
    parse_timestamp,
    seconds_text,
    unreadable,
)

__all__ = [
    "activity_status",
    "is_blank",
    "parse_amount",
    "parse_days",
    "parse_timestamp",
    "seconds_text",
    "unreadable",
]
