"""Scalar clinical expressions: blood pressure, temperature, ages, code spelling, scoring bands."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.columns import to_number


def systolic(value: Column) -> Column:
    """The number before the slash in ``"120/80"``, or the number itself in ``"120"``."""
    return to_number(F.split(value.cast("string"), "/").getItem(0))


def bp_parts(value: Column) -> tuple[Column, Column, Column]:
    """(systolic, diastolic, mean arterial pressure) from the leading and the after-slash digits."""
    top = F.regexp_extract(value, "^[0-9]+", 0).try_cast("double")
    bottom = F.regexp_extract(value, "(?<=/)[0-9]+", 0).try_cast("double")
    return top, bottom, (top + 2 * bottom) / 3


def celsius(value: Column, above: float = 42) -> Column:
    """Readings above ``above`` are taken as Fahrenheit and converted."""
    return F.when(value > above, (value - 32) * 5 / 9).otherwise(value)


def normalise_temp(value: Column, low: float = 32, high: float = 42) -> Column:
    """Celsius, with readings outside ``[low, high]`` null."""
    converted = celsius(value, high)
    return F.when(converted.between(low, high), converted)


def minutes_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later) / 60_000_000


def hours(n: float) -> Column:
    """``n`` hours as an interval, to be added to a timestamp."""
    return F.expr(f"make_dt_interval(0, 0, 0, {n * 3600:.6f})")


def age_years(birth: Column, at: Column, method: str = "calendar") -> Column:
    """Age by difference of calendar years (the cohort rule) or by days / 365.25."""
    if method == "calendar":
        return F.year(at) - F.year(birth)
    if method == "days":
        return F.datediff(at, birth) / 365.25
    raise ValueError(f"unknown method {method!r}")


def age_completed(birth: Column, at: Column) -> Column:
    """Completed years at a date, never below zero."""
    months = (
        (F.year(at) - F.year(birth)) * 12
        + (F.month(at) - F.month(birth))
        - (F.dayofmonth(at) < F.dayofmonth(birth)).cast("int")
    )
    return F.greatest(F.floor(months / 12), F.lit(0)).cast("int")


def normalise_icd(code: Column, variant: str = "full") -> Column:
    """``"dots"`` drops dots only; ``"full"`` drops dots and spaces and makes upper case."""
    if variant == "dots":
        return F.translate(code, ".", "")
    if variant == "full":
        return F.trim(F.upper(F.translate(code, ". ", "")))
    raise ValueError(f"unknown variant {variant!r}")


def poa_qualified(present_on_admission: Column, dx_type: Column) -> Column:
    """Evidence that a diagnosis was there before admission; missing information is no evidence."""
    said_yes = F.coalesce(F.lower(present_on_admission) == "yes", F.lit(False))
    from_history = F.coalesce(dx_type.isin(fv.POA_TYPES), F.lit(False))
    return said_yes | from_history


def null_placeholders(
    df: DataFrame, patterns: Iterable[str] = (fv.UNKNOWN_TEXT,), columns: Sequence[str] | None = None
) -> DataFrame:
    """Null out text that matches a placeholder pattern, in all string columns or the given ones."""
    targets = set(columns or [name for name, kind in df.dtypes if kind == "string"])

    def cleaned(name: str) -> Column:
        if name not in targets:
            return F.col(name)
        hit = reduce(lambda a, b: a | b, [F.col(name).rlike(p) for p in patterns])
        return F.when(~hit, F.col(name)).alias(name)

    return df.select(*[cleaned(c) for c in df.columns])


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the text holds one of the words; a missing text holds none."""
    return F.coalesce(reduce(lambda a, b: a | b, [text.contains(w) for w in words]), F.lit(False))


def like_any(text: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive SQL LIKE over several patterns."""
    return reduce(lambda a, b: a | b, [F.lower(text).like(p.lower()) for p in patterns])


def band_points(value: Column, bands: tuple[list[tuple[float, int]], int]) -> Column:
    """Points of the first band whose upper limit is not exceeded; null for a missing value."""
    limits, above = bands
    chain = F.when(value.isNull(), None)
    for limit, points in limits:
        chain = chain.when(value <= limit, points)
    return chain.otherwise(above)


def null_safe_sum(*parts: Column) -> Column:
    """Sum that takes missing parts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])


def n_pct(n: Column, total: Column, digits: int = 1) -> Column:
    """``n`` as a percentage of ``total``; null when the total is zero."""
    return F.round(100.0 * n / F.when(total != 0, total), digits)


def icu_flag(department_name: Column) -> Column:
    """Whether a department name is an intensive care unit."""
    return contains_any(F.upper(department_name), fv.ICU_WORDS)
