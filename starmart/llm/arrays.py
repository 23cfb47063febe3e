"""Array expressions that stay linear, or nearly so, for arrays of any length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.llm.common import let

BLOCK = 128


def upto(n: Column) -> Column:
    """0, 1, ... n - 1; empty for n = 0, where sequence() would count down."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def running(values: Column, merge: Callable[[Column, Column], Column], zero: Column) -> Column:
    """Each element merged with all before it.

    Blocks are folded first and then each block within itself, so that n elements cost about
    n * (BLOCK + n / BLOCK**2) steps and no array is copied for each of them.
    """

    def fold(array: Column) -> Column:
        return F.aggregate(array, zero, merge)

    def block_of(blocks: Column, totals: Column) -> Column:
        def one(block: Column, at: Column) -> Column:
            return let(
                fold(F.slice(totals, 1, at)),
                lambda base: F.transform(
                    block, lambda _, i: merge(base, fold(F.slice(block, 1, i + 1)))
                ),
            )

        return F.flatten(F.transform(blocks, one))

    def cut(array: Column) -> Column:
        number = F.ceil(F.size(array) / F.lit(BLOCK)).cast("int")
        return F.transform(upto(number), lambda b: F.slice(array, b * BLOCK + 1, BLOCK))

    return let(
        values,
        lambda array: let(
            cut(array),
            lambda blocks: let(F.transform(blocks, fold), lambda totals: block_of(blocks, totals)),
        ),
    )


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: an array of (start, end, size, found).

    start and end are code points, end exclusive; size is the length of the group; found is the
    match itself, which would take a walk from the text's beginning to cut out again.
    """

    def place(found: Column, between: Column, groups: Column) -> Column:
        gaps = F.transform(found, lambda _, i: (
            F.length(F.get(between, i))
            + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0)
        ).cast("long"))
        starts = running_total(gaps)
        # A gap counts the match before it, so its running total is where the next one starts.
        return F.transform(starts, lambda s, i: F.struct(
            s.alias("start"), (s + F.length(F.get(found, i))).alias("end"),
            F.length(F.get(groups, i)).alias("size"), F.get(found, i).alias("found"),
        ))

    regex = F.lit(pattern)
    return let(
        F.regexp_extract_all(text, regex, F.lit(0)),
        lambda found: let(
            F.split(text, pattern, -1),
            lambda between: let(
                F.regexp_extract_all(text, regex, F.lit(group)),
                lambda groups: place(found, between, groups),
            ),
        ),
    )


def running_total(values: Column) -> Column:
    return running(values, lambda a, b: a + b, F.lit(0).cast("long"))
