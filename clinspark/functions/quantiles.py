"""Exact numeric profiles without gathering a group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer.  Here the values are
counted first, the distinct values are dealt to ranges of values, and ranks are looked up range by range; the
largest unit of work is one range of one group, or the list of its ranges.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the values between a number and its double are cut into.
RANGES = 16_384
QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def _range_of(value: Column, ranges: int) -> Column:
    """A whole number that never falls while the value grows: the logarithm in steps, mirrored below zero.

    It needs nothing but the value, so no pass is spent on finding cuts.  Zero has a range of its own."""
    # logarithms of doubles lie between -745 and 710; infinity is held at the upper end
    steps = F.floor(F.least(F.log(F.abs(value)), F.lit(710.0)) * (ranges / math.log(2))) + (746 * 2 * ranges)
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * steps).cast("long")


def numeric_profile(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: dict[str, float] | None = None,
    ranges: int | None = None,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per group: ``n``, ``missing``, ``mean``, ``sd`` (sample), ``min``, ``max`` and quantiles.

    Quantiles interpolate linearly and are named by the keys of ``probabilities``.  ``n`` counts the
    rows that have a value; NaN is no value.  ``sums`` adds columns with the sum of other numbers over all rows of the group; they
    should take few values for each value of the column.  Everything is derived from one count per distinct value (and those numbers),
    which is the only shuffle of the input.  The values are dealt to ``ranges`` ranges for each doubling; a range's values and a
    group's ranges are what one task sees of a group.
    """
    probabilities, ranges = QUARTILES if probabilities is None else probabilities, ranges or RANGES
    extra = dict(sums or {})
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    # a struct of the groups is never missing itself, so that it joins and partitions as one plain key
    key = [F.struct(*groups).alias("_g")] if groups else []
    # without groups every distinct value carries the same key, made in the aggregation
    same_key = [] if groups else [F.min(F.lit(0)).alias("_g")]
    has = F.col("_v").isNotNull()
    # missing values are counted too and carry no weight below
    counted = (
        df.select(*key, number.alias("_v"), *[c.alias(f"_s_{n}") for n, c in extra.items()])
        .groupBy(*(["_g"] if groups else []), "_v", *[f"_s_{n}" for n in extra])
        .agg(F.count("*").alias("_rows"), *same_key)
        .withColumns({"_n": F.when(has, F.col("_rows")).otherwise(0), "_range": F.coalesce(F.when(has, _range_of(F.col("_v"), ranges)), F.lit(-(2**62)))})
    )
    # the range is never missing and the counted rows are the same wherever they are read, so Spark shuffles the input once
    per_range = counted.groupBy("_g", "_range").agg(
        F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows"), F.sum(F.col("_v") * F.col("_n")).alias("_sum"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"), *[F.sum(F.col(f"_s_{n}") * F.col("_rows")).alias(f"_s_{n}") for n in extra],
    )
    group = Window.partitionBy("_g")
    before_range = per_range.select(
        "_g", "_range",
        (F.sum("_n").over(group.orderBy("_range")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(group).alias("_total"),
        (F.sum("_rows").over(group) - F.sum("_n").over(group)).alias("_missing"),
        F.sum("_sum").over(group).alias("_sum"), F.min("_min").over(group).alias("_min"), F.max("_max").over(group).alias("_max"),
        *[F.sum(f"_s_{n}").over(group).alias(f"_t_{n}") for n in extra],
    )
    running = Window.partitionBy("_g", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        counted.select("_g", "_range", "_v", "_n").join(before_range, ["_g", "_range"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(running))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def rank(p: float) -> Column:
        return F.lit(p) * (F.col("_total") - 1)

    def value_at(position: Column) -> Column:
        return F.max(F.when((F.col("_start") <= position) & (position < F.col("_end")), F.col("_v")))

    picked = []
    for name, p in probabilities.items():
        picked += [
            value_at(F.floor(rank(p))).alias(f"_lo_{name}"),
            value_at(F.ceil(rank(p))).alias(f"_hi_{name}"),
        ]
    whole = ("_total", "_missing", "_sum", "_min", "_max", *[f"_t_{n}" for n in extra])
    away = F.col("_v") - F.col("_sum") / F.when(F.col("_total") > 0, F.col("_total"))
    ends = placed.groupBy("_g").agg(
        *[F.max(c).alias(c) for c in whole],
        F.sum(F.col("_n") * away * away).alias("_squares"),
        *picked,
    )
    if not groups:
        # one row even where the table has none
        ends = ends.agg(*[F.max(c).alias(c) for c in ends.columns if c != "_g"])
    present = F.when(F.col("_total") > 0, F.col("_total"))
    quantiles = [
        (
            F.col(f"_lo_{name}")
            + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (rank(p) - F.floor(rank(p)))
        ).alias(name)
        for name, p in probabilities.items()
    ]
    return ends.select(
        *[F.col(f"_g.{name}").alias(name) for name in groups],
        F.coalesce("_total", F.lit(0)).alias("n"),
        F.coalesce("_missing", F.lit(0)).alias("missing"),
        (F.col("_sum") / present).alias("mean"),
        F.sqrt(F.col("_squares") / F.when(F.col("_total") > 1, F.col("_total") - 1)).alias("sd"),
        F.col("_min").alias("min"),
        *quantiles,
        F.col("_max").alias("max"),
        *[F.col(f"_t_{n}").alias(n) for n in extra],
    )
