"""Time-windowed inclusion criteria and the filtered cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.columns import require_column, resolve_numeric, resolve_time
from clinspark.functions.scalars import n_pct, normalise_temp, systolic
from clinspark.operators.windows import in_window, within_window

KEY = "encounterkey"


def ed_arrival(visits: DataFrame) -> DataFrame:
    """Arrival time per encounter; an encounter with two arrival times keeps both."""
    arrival = resolve_time(visits, fv.ARRIVAL_INSTANTS, fv.ARRIVAL_PAIRS, "arrival time")
    return visits.select(KEY, arrival.alias("ed_arrival_time")).distinct()


def wbc_events(labs: DataFrame, items: Sequence[int] = fv.WBC_KEYS) -> DataFrame:
    return labs.where(F.col("labcomponentkey").isin(list(items))).select(
        KEY,
        resolve_time(labs, fv.LAB_INSTANTS, fv.LAB_PAIRS, "lab time").alias("event_time"),
        resolve_numeric(labs, fv.LAB_VALUES, "lab value").alias("event_value"),
    )


def temperature_events(
    flowsheets: DataFrame, items: Sequence[int] = fv.TEMPERATURE_KEYS, unit_policy: str = "raw"
) -> DataFrame:
    """Temperatures as recorded, or converted to plausible Celsius (``unit_policy="normalise"``)."""
    value = resolve_numeric(flowsheets, fv.VITAL_VALUES, "temperature value")
    return flowsheets.where(F.col("flowsheetrowkey").isin(list(items))).select(
        KEY,
        resolve_time(flowsheets, fv.VITAL_INSTANTS, fv.VITAL_PAIRS, "vital time").alias("event_time"),
        (normalise_temp(value) if unit_policy == "normalise" else value).alias("event_value"),
    )


def pressure_events(flowsheets: DataFrame, items: Sequence[int] = fv.BLOOD_PRESSURE_KEYS) -> DataFrame:
    value = require_column(flowsheets, fv.BP_VALUES, "blood pressure value")
    return flowsheets.where(F.col("flowsheetrowkey").isin(list(items))).select(
        KEY,
        resolve_time(flowsheets, fv.VITAL_INSTANTS, fv.VITAL_PAIRS, "vital time").alias("event_time"),
        systolic(F.col(value)).alias("event_value"),
    )


def imaging_events(imaging: DataFrame) -> DataFrame:
    return imaging.select(
        KEY,
        resolve_time(imaging, fv.IMAGING_INSTANTS, fv.IMAGING_PAIRS, "imaging time").alias("event_time"),
        F.lit(None).cast("double").alias("event_value"),
    )


def _first_value(condition: Column | None = None) -> Column:
    """The earliest event value that is present; equal times go to the smaller value."""
    present = F.col("event_value").isNotNull()
    if condition is not None:
        present = present & condition
    return F.min(F.when(present, F.struct("event_time", "event_value")))["event_value"]


def _abnormal_temp() -> Column:
    return (F.col("event_value") < fv.TEMP_LOW) | (F.col("event_value") > fv.TEMP_HIGH)


def _abnormal_wbc(value: Column) -> Column:
    return F.coalesce((value > fv.WBC_HIGH) | (value < fv.WBC_LOW), F.lit(False))


def first_cbc_in_window(
    labs: DataFrame, arrival: DataFrame, window: float = fv.CBC_HOURS, items: Sequence[int] = fv.WBC_KEYS
) -> DataFrame:
    """First blood count time and first non-missing value, which may be of a later sample."""
    events = within_window(wbc_events(labs, items), arrival, "event_time", "ed_arrival_time", 0, window)
    return events.groupBy(KEY).agg(
        F.min("event_time").alias("first_cbc_time"), _first_value().alias("first_wbc_value")
    )


def abnormal_temp(
    flowsheets: DataFrame, arrival: DataFrame, window: float = fv.CBC_HOURS, unit_policy: str = "raw"
) -> DataFrame:
    """Encounters with an abnormal temperature at any time in the window."""
    events = temperature_events(flowsheets, unit_policy=unit_policy)
    inside = within_window(events, arrival, "event_time", "ed_arrival_time", 0, window)
    return inside.where(_abnormal_temp()).select(KEY).distinct().withColumn("has_abnormal_temp", F.lit(True))


def abnormal_temp_or_wbc(temp: DataFrame, cbc: DataFrame) -> DataFrame:
    """Encounters with either criterion, a criterion not met being false."""
    wbc = cbc.where(_abnormal_wbc(F.col("first_wbc_value"))).select(
        KEY, F.lit(False).alias("has_abnormal_temp"), F.lit(True).alias("has_abnormal_wbc")
    )
    either = temp.select(KEY, "has_abnormal_temp", F.lit(False).alias("has_abnormal_wbc")).unionByName(wbc)
    return (
        either.groupBy(KEY)
        .agg(
            F.bool_or("has_abnormal_temp").alias("has_abnormal_temp"),
            F.bool_or("has_abnormal_wbc").alias("has_abnormal_wbc"),
        )
        .withColumn("meets_sirs_criteria", F.col("has_abnormal_temp") | F.col("has_abnormal_wbc"))
    )


def chest_imaging(imaging: DataFrame, arrival: DataFrame, window: float = fv.IMAGING_HOURS) -> DataFrame:
    """First chest imaging in the window."""
    events = within_window(imaging_events(imaging), arrival, "event_time", "ed_arrival_time", 0, window)
    return (
        events.groupBy(KEY)
        .agg(F.min("event_time").alias("first_imaging_time"))
        .withColumn("has_chest_imaging", F.lit(True))
    )


def hypotension(
    flowsheets: DataFrame, arrival: DataFrame, window: float = fv.HYPOTENSION_HOURS
) -> DataFrame:
    """First low systolic pressure in the window and the lowest one."""
    low = pressure_events(flowsheets).where(F.col("event_value") < fv.SBP_LOW)
    events = within_window(low, arrival, "event_time", "ed_arrival_time", 0, window)
    return (
        events.groupBy(KEY)
        .agg(F.min("event_time").alias("first_hypotension_time"), F.min("event_value").alias("min_sbp"))
        .withColumn("has_hypotension", F.lit(True))
    )


def encounter_criteria(
    labs: DataFrame, flowsheets: DataFrame, imaging: DataFrame, arrival: DataFrame
) -> DataFrame:
    """All criteria of an encounter in one pass.

    Blood counts, temperatures, pressures and images are stacked into one narrow event table, joined
    with the arrival once and reduced in one aggregation, instead of one join per criterion.  Rows
    that can meet no criterion are dropped before the shuffle.
    """
    kinds = {
        "cbc": (wbc_events(labs), fv.CBC_HOURS),
        "temp": (
            # only the fact of an abnormal temperature is needed further on
            temperature_events(flowsheets)
            .where(_abnormal_temp())
            .withColumn("event_value", F.lit(None).cast("double")),
            fv.CBC_HOURS,
        ),
        "sbp": (pressure_events(flowsheets).where(F.col("event_value") < fv.SBP_LOW), fv.HYPOTENSION_HOURS),
        "image": (imaging_events(imaging), fv.IMAGING_HOURS),
    }
    stacked = None
    inside = F.lit(False)
    for kind, (events, window) in kinds.items():
        tagged = events.where(F.col("event_time").isNotNull()).withColumn("kind", F.lit(kind))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
        hit = in_window(F.col("event_time"), F.col("ed_arrival_time"), 0, window)
        inside = inside | ((F.col("kind") == kind) & hit)

    def is_kind(kind: str) -> Column:
        return F.col("kind") == kind

    def first_time(kind: str) -> Column:
        return F.min(F.when(is_kind(kind), F.col("event_time")))

    return (
        stacked.join(arrival, KEY)
        .where(inside)
        .groupBy(KEY)
        .agg(
            first_time("cbc").alias("first_cbc_time"),
            _first_value(is_kind("cbc")).alias("first_wbc_value"),
            F.bool_or(is_kind("temp")).alias("has_abnormal_temp"),
            F.bool_or(is_kind("image")).alias("has_chest_imaging"),
            first_time("image").alias("first_imaging_time"),
            F.bool_or(is_kind("sbp")).alias("has_hypotension"),
            first_time("sbp").alias("first_hypotension_time"),
            F.min(F.when(is_kind("sbp"), F.col("event_value"))).alias("min_sbp"),
        )
        .withColumn("has_abnormal_wbc", _abnormal_wbc(F.col("first_wbc_value")))
        .withColumn("meets_sirs_criteria", F.col("has_abnormal_temp") | F.col("has_abnormal_wbc"))
    )


COHORT_COLUMNS = [
    KEY, "first_cbc_time", "first_wbc_value", "has_abnormal_temp", "has_abnormal_wbc",
    "meets_sirs_criteria", "has_chest_imaging", "first_imaging_time", "has_hypotension",
    "first_hypotension_time", "min_sbp", "time_zero", "ed_arrival_time",
]


def filtered_cohort(
    visits: DataFrame, labs: DataFrame, flowsheets: DataFrame, imaging: DataFrame
) -> DataFrame:
    """Encounters with an early blood count and an abnormal temperature or count; time zero is the count.

    An encounter with several arrival times gives one row for each, as its arrival is joined back.
    """
    arrival = ed_arrival(visits)
    criteria = encounter_criteria(labs, flowsheets, imaging, arrival)
    included = criteria.where(F.col("first_cbc_time").isNotNull() & F.col("meets_sirs_criteria"))
    return (
        included.join(arrival, KEY)
        .withColumn("time_zero", F.col("first_cbc_time"))
        .select(*COHORT_COLUMNS)
    )


def hypotensive(cohort: DataFrame) -> DataFrame:
    return cohort.where("has_hypotension")


def attrition(visits: DataFrame, keys: DataFrame, criteria: DataFrame) -> DataFrame:
    """Encounters left at each step and their share of the extracted encounters.

    ``criteria`` holds one row per encounter, so each step is one conditional count of one aggregate.
    """
    has_cbc = F.col("first_cbc_time").isNotNull()
    meets = F.col("meets_sirs_criteria")
    steps = [
        ("2 blood count in window", has_cbc),
        ("3 abnormal temperature", F.col("has_abnormal_temp")),
        ("4 abnormal blood count", F.col("has_abnormal_wbc")),
        ("5 either abnormal", meets),
        ("6 cohort", has_cbc & meets),
        ("7 cohort with chest imaging", has_cbc & meets & F.col("has_chest_imaging")),
        ("8 cohort with hypotension", has_cbc & meets & F.col("has_hypotension")),
    ]
    counts = criteria.agg(*[F.count(F.when(test, True)).alias(name) for name, test in steps])
    long = counts.unpivot([], [name for name, _ in steps], "step", "n")
    extracted = keys.agg(F.count("*").alias("n")).select(F.lit("0 extracted").alias("step"), "n")
    arrived = ed_arrival(visits).agg(F.count("*").alias("n")).select(F.lit("1 arrival time").alias("step"), "n")
    total = keys.agg(F.count("*").alias("n")).scalar()
    return extracted.unionByName(arrived).unionByName(long).withColumn("pct", n_pct(F.col("n"), total))


def cohort_by_source(cohort: DataFrame, source: str = "source") -> DataFrame:
    """Encounters and flag counts per source of a combined cohort."""

    def flag(name: str) -> Column:
        return F.sum(F.col(name).cast("long"))

    return cohort.groupBy(source).agg(
        F.count("*").alias("n"),
        flag("has_chest_imaging").alias("n_imaging"),
        flag("has_hypotension").alias("n_hypotensive"),
    )
