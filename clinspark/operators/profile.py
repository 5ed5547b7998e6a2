"""Looking into a fact table: what it holds, which items match a name, which values do not parse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.functions.columns import to_number
from clinspark.functions.scalars import like_any


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column with its type and the row total."""
    total = df.agg(F.count("*").alias("n_rows"))
    listed = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(t).alias("type")) for n, t in df.dtypes])
    return total.select(F.explode(listed).alias("c"), "n_rows").select("c.column", "c.type", "n_rows")


def accepted_only(events: DataFrame, value: str = "numericvalue", accepted: str = "accepted") -> DataFrame:
    """Accepted events that have a value."""
    return events.where((F.col(accepted) == 1) & F.col(value).isNotNull())


def unparseable_census(df: DataFrame, column: str) -> DataFrame:
    """Count per text that is no number."""
    return (
        df.where(F.col(column).isNotNull() & to_number(F.col(column)).isNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
    )


def top_items(df: DataFrame, columns: Sequence[str], k: int = 30) -> DataFrame:
    """The most frequent items; equal counts in the order of their columns."""
    return (
        df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns).limit(k)
    )


def item_search(
    df: DataFrame, name: str, patterns: Sequence[str], columns: Sequence[str], k: int = 20
) -> DataFrame:
    """The most frequent items whose name is like one of the patterns."""
    return top_items(df.where(like_any(F.col(name), patterns)), columns, k)
