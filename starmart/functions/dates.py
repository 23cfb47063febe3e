"""Calendar expressions.

Everything goes through ``date``, never through the zoned ``timestamp``, so no
result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(moment: Column) -> Column:
    """``yyyymmdd`` as an integer, computed without building text."""
    day = moment.cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def days_between(start: Column, end: Column) -> Column:
    """Signed number of midnights crossed from ``start`` to ``end``."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def month_start(moment: Column) -> Column:
    """Midnight of the first day of the month, as a zone-free timestamp."""
    return F.trunc(moment.cast("date"), "MM").cast("timestamp_ntz")


def day_of_week(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(day) - 1).cast("bigint")


def date_spine(bounds: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included.

    A NULL bound or a reversed pair gives no rows. One input row becomes a few
    thousand days at most, so the explode needs no spreading.
    """
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    ordered = F.when(F.col(first) <= F.col(last), days)
    return bounds.select(F.explode(ordered).alias(name))
