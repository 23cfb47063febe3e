"""Joining a table whose key may be hot to a table with one row per key.

A shuffle sends all rows of a key to one task. Adaptive execution splits such a
partition only when both join inputs are plain shuffles; a grouped input, already
partitioned by the key, is not one. Here the few hot keys are found first and
their rows are joined to a broadcast of the at most ``MAX_HOT_KEYS`` matching
rows instead, leaving the rest an ordinary join that reuses the grouping's
partitioning.

Hot keys that nobody has noted before are found by the join itself: a sketch of the
key column is broadcast, and where it names no key, adaptive execution drops the
other way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# A key is hot from a thousandth of all rows on, so no more than 1000 can be.
MAX_HOT_KEYS = 1000
TRACKED_KEYS = 20_000
# Rows one task handles without trouble, however large their share.
MIN_HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class HotKeys:
    """Keys holding a large share of a table, and whether NULL is one of them."""

    values: tuple[str, ...] = ()
    nulls: bool = False

    def __bool__(self) -> bool:
        return bool(self.values) or self.nulls

    def matches(self, key: Column) -> Column:
        """True for hot keys and for NULL, never NULL itself."""
        return key.isNull() | F.coalesce(key.isin(*self.values), F.lit(False))


def find_hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS) -> HotKeys:
    """One pass over the key column with a fixed-size sketch and no row shuffle.

    Only the sketch's few survivors reach the driver. They decide the shape of
    the plan, never its result, so an estimate is good enough.
    """
    return _hot(df.agg(*_sketch(key)).first().asDict(), min_rows)


def observe_hot_keys(
    df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS
) -> tuple[DataFrame, Callable[[], HotKeys]]:
    """``df``, and its hot keys once the first action on it has run."""
    seen = Observation()
    watched = df.observe(seen, *_sketch(key))
    return watched, lambda: _hot(seen.get, min_rows)


def hot_key_rows(df: DataFrame, key: str, min_rows: int | None = None) -> DataFrame:
    """The hot keys of ``df`` as rows (``hot_key``), found when the plan runs.

    One pass over the key column; at most ``MAX_HOT_KEYS`` rows, and one for NULL.
    """
    share = F.greatest(
        F.col("total") / MAX_HOT_KEYS, F.lit(MIN_HOT_ROWS if min_rows is None else min_rows)
    )
    named = F.filter("top", lambda t: t["item"].isNotNull() & (t["count"] >= share))
    keys = F.transform(named, lambda t: t["item"])
    missing = F.when(F.col("nulls") >= share, F.array(F.lit(None).cast("string")))
    nothing = F.array().cast("array<string>")
    return df.agg(*_sketch(key)).select(
        F.explode(F.concat(keys, F.coalesce(missing, nothing))).alias("hot_key")
    )


def _sketch(key: str) -> list[Column]:
    text = F.col(key).cast("string")
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(text.isNull()).alias("nulls"),
        F.expr(
            f"approx_top_k(CAST(`{key}` AS STRING), {MAX_HOT_KEYS}, {TRACKED_KEYS})"
        ).alias("top"),
    ]


def _hot(found: Mapping, min_rows: int) -> HotKeys:
    share = max(found["total"] / MAX_HOT_KEYS, min_rows)
    values = tuple(
        row["item"] for row in found["top"] if row["item"] is not None and row["count"] >= share
    )
    return HotKeys(values, found["nulls"] >= share)


def left_join_unique(
    left: DataFrame, right: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """Left join on a text key; ``right`` has at most one row per non-NULL key.

    ``hot``: the hot keys of ``left``, where they are known; else the plan finds them.
    """
    if hot is None:
        # At most MAX_HOT_KEYS + 1 rows, like those of ``right`` that match them.
        names = F.broadcast(hot_key_rows(left, key))
        is_hot = F.col(key).eqNullSafe(F.col("hot_key"))
        matching = F.broadcast(right.join(names, F.col(key) == F.col("hot_key"), "left_semi"))
        spread = left.join(names, is_hot, "left_semi").join(matching, key, "left")
        cold = left.join(names, is_hot, "left_anti")
        return cold.join(right, key, "left").unionByName(spread)
    if not hot:
        return left.join(right, key, "left")
    is_hot = hot.matches(F.col(key))
    # One row per key at most, so the broadcast is bounded by MAX_HOT_KEYS rows.
    hot_right = F.broadcast(right.filter(F.col(key).isin(*hot.values)))
    spread = left.filter(is_hot).join(hot_right, key, "left")
    return left.filter(~is_hot).join(right, key, "left").unionByName(spread)
