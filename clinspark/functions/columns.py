"""Resolving columns, times and numbers whose names differ between sites.

All choices are made on ``df.columns`` while the plan is built, so nothing here runs a job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# digits with an optional exponent, or infinity; keeps Java's "12d" and "12f" from passing as numbers
NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that ``df`` has, whatever its case; ``None`` if it has none of them."""
    present = {c.lower(): c for c in df.columns}
    return next((present[c.lower()] for c in candidates if c.lower() in present), None)


def require_column(df: DataFrame, candidates: Sequence[str], what: str) -> str:
    """Like :func:`resolve_column`, but raises when no candidate is present."""
    name = resolve_column(df, candidates)
    if name is None:
        raise ValueError(f"no {what} column among {df.columns}; looked for {list(candidates)}")
    return name


def resolve_time(
    df: DataFrame,
    instants: Sequence[str],
    date_time_pairs: Sequence[tuple[str, str]],
    what: str = "time",
) -> Column:
    """A timestamp column: the first instant present, else a date joined with its time of day.

    Text that is no timestamp becomes null.  A pair whose time of day is absent gives midnight.
    """
    instant = resolve_column(df, instants)
    if instant is not None:
        return F.col(instant).try_cast("timestamp_ntz")
    for date_name, time_name in date_time_pairs:
        date = resolve_column(df, [date_name])
        if date is None:
            continue
        time = resolve_column(df, [time_name])
        if time is None:
            return F.col(date).try_cast("timestamp_ntz")
        joined = F.concat(F.col(date).cast("string"), F.lit(" "), F.col(time).cast("string"))
        return joined.try_cast("timestamp_ntz")
    raise ValueError(f"no {what} column among {df.columns}")


def to_number(value: Column) -> Column:
    """Text as a double; text that is no number becomes null."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def resolve_numeric(df: DataFrame, candidates: Sequence[str], what: str = "value") -> Column:
    """The first candidate value column as a double, unparseable text as null."""
    name = require_column(df, candidates, what)
    if dict(df.dtypes)[name] == "string":
        return to_number(F.col(name))
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys of which a missing one equals a missing one, as in a grouping."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])
