"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every key ever issued depends on them.
KEY_SEPARATOR = "||"
NULL_TOKEN = "_null_"


def surrogate_key(*fields: str | Column) -> Column:
    """md5 hex of the fields' text, joined by ``||``, NULL written as ``_null_``.

    The key is a function of the natural key alone, so facts and dimensions
    compute it independently and no lookup join is needed. Nothing is escaped:
    ``('a||b', 'c')`` and ``('a', 'b||c')`` share one key. Use it on text,
    integer, boolean, date and zone-free timestamp fields; the text of large
    doubles differs between engines.
    """
    if not fields:
        raise ValueError("a surrogate key needs at least one field")
    columns = [F.col(f) if isinstance(f, str) else f for f in fields]
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts) if len(parts) > 1 else parts[0])
