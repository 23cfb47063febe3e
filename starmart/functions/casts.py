"""Text to typed columns.

A value that cannot be read stops the job with its column and text, whatever
the session's ANSI setting, so bad input never turns into silent NULLs.
Columns that already arrive typed (a Parquet extract) are not re-parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _or_fail(parsed: Column, source: Column, name: str, target: str) -> Column:
    message = F.concat(
        F.lit(f"column {name}: cannot read '"), source, F.lit(f"' as {target}")
    )
    return F.coalesce(parsed, F.when(source.isNotNull(), F.raise_error(message)))


def to_text(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    return column if _is_text(df, name) else column.cast("string").alias(name)


def blank_to_null(df: DataFrame, name: str) -> Column:
    """Empty text becomes NULL; a blank is not empty."""
    return F.nullif(F.col(name), F.lit("")).alias(name)


def to_int(df: DataFrame, name: str) -> Column:
    """Text to int; a fraction is rounded half away from zero ('12.5' is 13)."""
    source = F.col(name)
    if not _is_text(df, name):
        return source.cast("int").alias(name)
    rounded = F.round(source.try_cast("double")).try_cast("int")
    parsed = F.coalesce(source.try_cast("int"), rounded)
    return _or_fail(parsed, source, name, "int").alias(name)


def to_double(df: DataFrame, name: str) -> Column:
    source = F.col(name)
    if not _is_text(df, name):
        return source.cast("double").alias(name)
    return _or_fail(source.try_cast("double"), source, name, "double").alias(name)


def to_timestamp(df: DataFrame, name: str, blank_is_null: bool = True) -> Column:
    """Text to a zone-free timestamp.

    With ``blank_is_null`` off, empty text is an error like any other bad value.
    """
    source = F.col(name)
    if not _is_text(df, name):
        return source.cast("timestamp_ntz").alias(name)
    if blank_is_null:
        source = F.nullif(source, F.lit(""))
    parsed = source.try_cast("timestamp_ntz")
    return _or_fail(parsed, source, name, "timestamp").alias(name)
