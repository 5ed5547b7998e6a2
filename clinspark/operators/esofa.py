"""eSOFA organ dysfunction flags around a window after inclusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.columns import to_number
from clinspark.functions.scalars import null_safe_sum
from clinspark.operators.windows import first_row, in_window

KEY = "encounterkey"
LABS = {
    "lactate": fv.ESOFA_LACTATE,
    "creatinine": fv.ESOFA_CREATININE,
    "bilirubin": fv.ESOFA_BILIRUBIN,
    "platelet": fv.ESOFA_PLATELET,
}
PARTS = [
    "esofa_pressor", "esofa_mv", "esofa_lactate", "esofa_creatinine", "esofa_bilirubin", "esofa_platelet",
]


def lab_baseline(
    labs: DataFrame, names: Sequence[str], label: str, floor: float | None = None
) -> DataFrame:
    """The first result of an encounter; with a floor, encounters starting below it have none.

    A first result that is no number stays as a missing baseline and flags nothing.
    """
    results = labs.where(F.col("componentname").isin(list(names))).select(
        KEY, "ts", to_number(F.col("value")).alias(label)
    )
    first = first_row(results, [KEY], ["ts"], [label]).select(KEY, label)
    return first if floor is None else first.where(F.col(label) >= floor)


def _when_true(condition: Column) -> Column:
    """1 where the condition holds, else missing."""
    return F.when(condition, 1)


def before_midpoint(events: DataFrame, window: DataFrame, flag: str, time: str = "ts") -> DataFrame:
    """Encounters with any event before the window's midpoint, and the first such time."""
    return (
        events.join(window.select(KEY, "midpoint_timestamp"), KEY)
        .where(F.col(time) < F.col("midpoint_timestamp"))
        .groupBy(KEY)
        .agg(F.min(time).alias("first_time"))
        .withColumn(flag, F.lit(1))
    )


def esofa_pressor(administrations: DataFrame, window: DataFrame, time: str = "administrationinstant") -> DataFrame:
    return before_midpoint(administrations, window, "esofa_pressor", time)


def esofa_vent(
    flow: DataFrame, window: DataFrame, names: Sequence[str] = fv.VENTILATION_ROWS, time: str = "ts"
) -> DataFrame:
    rows = flow.where(F.col("flowsheetrowname").isin(list(names)))
    return before_midpoint(rows, window, "esofa_mv", time)


def lab_events(labs: DataFrame) -> DataFrame:
    """Results of the scored components as ``(encounterkey, kind, ts, v)``."""
    kind = F.lit(None).cast("string")
    for label, names in LABS.items():
        kind = F.when(F.col("componentname").isin(names), label).otherwise(kind)
    every = [name for names in LABS.values() for name in names]
    return labs.where(F.col("componentname").isin(every)).select(
        KEY, kind.alias("kind"), "ts", to_number(F.col("value")).alias("v")
    )


def _lab_extremes(kind: str, inside: Column) -> list[Column]:
    """Baseline and the extremes inside the window; a rule that some value passes holds for an extreme."""
    of_kind = F.col("kind") == kind
    record = F.struct(F.col("ts"), F.col("v").isNull().alias("n"), F.col("v"))
    return [
        F.min(F.when(of_kind, record))["v"].alias(f"baseline_{kind}"),
        F.max(F.when(of_kind & inside, F.col("v"))).alias(f"max_{kind}"),
        F.min(F.when(of_kind & inside, F.col("v"))).alias(f"min_{kind}"),
    ]


def lab_flags() -> dict[str, Column]:
    """The lab rules over ``baseline_``, ``max_`` and ``min_`` columns of each kind."""
    base, top, low = (lambda k: F.col(f"baseline_{k}")), (lambda k: F.col(f"max_{k}")), F.col("min_platelet")
    return {
        "esofa_lactate": _when_true(top("lactate") >= 2),
        "esofa_creatinine": _when_true(top("creatinine") >= base("creatinine") * 2),
        "esofa_bilirubin": _when_true((top("bilirubin") >= base("bilirubin") * 2) & (top("bilirubin") >= 2)),
        "esofa_platelet": _when_true(
            (low < 100) & (base("platelet") >= 100) & (base("platelet") / 2 >= low)
        ),
    }


def _in_window() -> Column:
    return in_window(F.col("ts"), F.col("begin_timestamp"), 0, None, "none") & in_window(
        F.col("ts"), F.col("end_timestamp"), None, 0, "none"
    )


def esofa_vs_baseline(labs: DataFrame, window: DataFrame) -> DataFrame:
    """Lab flags of the included encounters with the baselines they were measured against."""
    events = lab_events(labs).join(window.select(KEY, "begin_timestamp", "end_timestamp"), KEY)
    extremes = [c for kind in LABS for c in _lab_extremes(kind, _in_window())]
    baselines = ["baseline_creatinine", "baseline_bilirubin", "baseline_platelet"]
    return events.groupBy(KEY).agg(*extremes).select(
        KEY, *baselines, *[flag.alias(name) for name, flag in lab_flags().items()]
    )


def esofa(
    window: DataFrame, pressors: DataFrame, ventilation: DataFrame, labs: DataFrame
) -> DataFrame:
    """All flags per included encounter, their number and whether there is any.

    ``pressors`` and ``ventilation`` are ``(encounterkey, ts)`` events.  They and the labs are stacked, joined to the window
    once, and reduced per row of the window on the same partitioning; an encounter without events keeps its row.
    """

    def marked(events: DataFrame, kind: str) -> DataFrame:
        return events.select(KEY, F.lit(kind).alias("kind"), "ts", F.lit(None).cast("double").alias("v"))

    stacked = (
        lab_events(labs)
        .unionByName(marked(pressors, "pressor"))
        .unionByName(marked(ventilation, "ventilation"))
    )

    def early(kind: str) -> Column:
        return F.max(F.when((F.col("kind") == kind) & (F.col("ts") < F.col("midpoint_timestamp")), 1))

    columns = list(window.columns)
    extremes = [c for kind in LABS for c in _lab_extremes(kind, _in_window())]
    parts = (
        window.join(stacked, KEY, "left")
        .groupBy(*columns)
        .agg(early("pressor").alias("esofa_pressor"), early("ventilation").alias("esofa_mv"), *extremes)
        .select(
            *columns, "esofa_pressor", "esofa_mv", *[flag.alias(name) for name, flag in lab_flags().items()]
        )
        .select(*columns, *PARTS)
    )
    return parts.withColumn("esofa_count", null_safe_sum(*[F.col(p) for p in PARTS])).withColumn(
        "esofa_binary", (F.col("esofa_count") > 0).cast("int")
    )
