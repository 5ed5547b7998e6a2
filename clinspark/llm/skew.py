"""Joins of a large frame, in which one key may hold much of the rows, with one row for each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from so many rows on, and never are more than ``HOT_KEYS`` keys hot.
HOT_ROWS = 50_000
HOT_KEYS = 10_000


def join_unique(large: DataFrame, one: DataFrame, on: list[str]) -> DataFrame:
    """The inner join on the columns ``on``, none of them null; ``one`` has each key once.

    Keys with more than ``HOT_ROWS`` rows, or a ten thousandth of all rows if that is more, are joined by broadcast: at most ``HOT_KEYS``
    rows at any size, of which only the keys and the columns of ``one`` are sent.  All others are joined by shuffle.  ``large``
    is read three times and should be a stored table."""
    limit = max(HOT_ROWS, large.count() // HOT_KEYS)
    hot = large.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(*on)
    keys = hot.collect()
    if not keys:
        return large.join(one, on)
    hot = large.sparkSession.createDataFrame(keys, hot.schema)
    found = large.join(F.broadcast(one.join(F.broadcast(hot), on, "left_semi")), on)
    return found.unionByName(large.join(F.broadcast(hot), on, "left_anti").join(one, on))
