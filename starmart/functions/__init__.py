"""Column expressions shared by staging, marts and reports."""

from starmart.functions.casts import (
    blank_to_null,
    to_double,
    to_int,
    to_text,
    to_timestamp,
)
from starmart.functions.dates import (
    date_key,
    date_spine,
    day_of_week,
    days_between,
    month_start,
)
from starmart.functions.keys import surrogate_key

__all__ = [
    "blank_to_null",
    "date_key",
    "date_spine",
    "day_of_week",
    "days_between",
    "month_start",
    "surrogate_key",
    "to_double",
    "to_int",
    "to_text",
    "to_timestamp",
]
