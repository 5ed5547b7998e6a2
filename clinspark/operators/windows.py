"""Aligning events to an anchor time, and first or last rows per group.

First and last rows are minima and maxima of a struct, so they are reduced on the map side: a key
that holds a large share of all rows sends one row per map task to the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.functions.scalars import hours


def first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The first row of each group in the order given, missing values last.

    ``order`` and ``keep`` columns are returned; ``keep`` columns also break ties, so the result does
    not depend on the order in which rows are read.
    """
    rank = [F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(c) for c in [*order, *keep]]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rank)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}.v").alias(c) for c in [*order, *keep]])


def last_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The last row of each group; missing values count as earliest."""
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, *keep)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*order, *keep]])


def first_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 5, rank: str = "rn"
) -> DataFrame:
    """The first ``n`` rows of each group with their rank.

    Spark limits each group to ``n`` rows before the shuffle, so a large group stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def in_window(
    time: Column, anchor: Column, low: float | None, high: float | None, closed: str = "both"
) -> Column:
    """Whether ``time`` lies within ``low`` to ``high`` hours of the anchor.

    ``closed`` says which ends belong to the window: ``both``, ``left`` or ``none``.
    """
    inside = time.isNotNull() & anchor.isNotNull()
    if low is not None:
        start = anchor + hours(low) if low else anchor
        inside = inside & (time >= start if closed in ("both", "left") else time > start)
    if high is not None:
        end = anchor + hours(high) if high else anchor
        inside = inside & (time <= end if closed == "both" else time < end)
    return inside


def within_window(
    events: DataFrame,
    anchor: DataFrame,
    time: str,
    anchor_time: str,
    low: float | None = 0,
    high: float | None = None,
    key: str = "encounterkey",
    closed: str = "both",
) -> DataFrame:
    """Events joined with the anchor of their encounter, those inside the window only."""
    joined = events.join(anchor.select(key, anchor_time), key)
    return joined.where(in_window(F.col(time), F.col(anchor_time), low, high, closed))


def last_before_anchor(
    events: DataFrame,
    anchor: DataFrame,
    time: str,
    value: str,
    anchor_time: str,
    keys: Sequence[str] = ("encounterkey",),
) -> DataFrame:
    """Value and time of the last event strictly before the anchor; ties go to the larger value."""
    before = within_window(events, anchor, time, anchor_time, None, 0, keys[0], closed="none")
    return last_row(before, keys, [time], [value])
