"""SIRS and NEWS2 scores from the first accepted measurement of an encounter.

All items of a score are picked in one aggregation per encounter, so a score costs one shuffle
whatever the number of its parts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.columns import to_number
from clinspark.functions.scalars import band_points, bp_parts, hours, normalise_temp, null_safe_sum
from clinspark.operators.windows import first_row

KEY = "encounterkey"
EYE, VERBAL, MOTOR = fv.GCS_FULL
OXYGEN, OXYGEN_2 = "FiO2 (%)", "FiO2 (%) - O2 Device #2"


def first_value_per_item(
    events: DataFrame, item: str = "item", time: str = "ts", value: str = "numericvalue"
) -> DataFrame:
    """First value per encounter and item; equal times go to the smaller value."""
    return first_row(events.where(F.col(value).isNotNull()), [KEY, item], [time], [value])


def score_measures(flow: DataFrame) -> DataFrame:
    """Accepted measurements as ``(encounterkey, item, ts, measure)``.

    Temperatures are plausible Celsius values and pressures systolic; a pressure text without a
    leading number stays as a missing measure, as it is still the first pressure taken.
    """
    item = F.col("item")
    measure = (
        F.when(item == "Temp", normalise_temp(F.col("numericvalue")))
        .when(item == "BP", bp_parts(F.col("value"))[0])
        .otherwise(F.col("numericvalue"))
    )
    usable = F.when(item == "BP", F.col("value").isNotNull() & (F.col("value") != "")).otherwise(
        F.col("measure").isNotNull()
    )
    return (
        flow.where(F.col("accepted") == 1)
        .withColumn("measure", measure)
        .where(usable)
        .select(KEY, "item", "ts", "measure")
    )


def lab_measures(labs: DataFrame) -> DataFrame:
    """Parseable lab results in the same shape."""
    return labs.select(
        KEY, F.col("componentname").alias("item"), "ts", to_number(F.col("value")).alias("measure")
    ).where(F.col("measure").isNotNull())


def firsts_wide(measures: DataFrame, picks: Mapping[str, Column]) -> DataFrame:
    """Per encounter, the first row of each condition as a struct ``(t, v)`` under the given name."""
    record = F.struct(F.col("ts").alias("t"), F.col("measure").isNull().alias("n"), F.col("measure").alias("v"))
    return measures.groupBy(KEY).agg(
        *[F.min(F.when(condition, record)).alias(name) for name, condition in picks.items()]
    )


def _is(*names: str) -> Column:
    return F.col("item").isin(list(names))


def _flag(condition: Column) -> Column:
    """1, 0, or null where the condition is not known."""
    return condition.cast("int")


def temp_flag(value: Column) -> Column:
    return _flag((value > 38) | (value < 36))


def wbc_flag(value: Column) -> Column:
    return _flag((value > 12) | (value < 4))


def sirs_score(flow: DataFrame, labs: DataFrame) -> DataFrame:
    """Four SIRS flags and their sum, missing flags adding nothing."""
    measures = score_measures(flow).unionByName(lab_measures(labs.where(F.col("componentname") == "WBC Count")))
    picks = {"temp": _is("Temp"), "pulse": _is("Pulse"), "resp": _is("Resp"), "wbc": _is("WBC Count")}
    firsts = firsts_wide(measures.where(_is("Temp", "Pulse", "Resp", "WBC Count")), picks)
    flags = {
        "sirs_temp": temp_flag(F.col("temp.v")),
        "sirs_pulse": _flag(F.col("pulse.v") > 90),
        "sirs_resp_rate": _flag(F.col("resp.v") > 20),
        "sirs_wbc": wbc_flag(F.col("wbc.v")),
    }
    scored = firsts.select(KEY, *[flag.alias(name) for name, flag in flags.items()])
    return scored.withColumn("sirs_score", null_safe_sum(*[F.col(name) for name in flags]))


def _news_firsts(flow: DataFrame) -> DataFrame:
    single = {
        "resp": "Resp", "spo2": "SpO2", "temp": "Temp", "bp": "BP", "pulse": "Pulse",
        "eye": EYE, "verbal": VERBAL, "motor": MOTOR,
    }
    on_oxygen = F.col("measure") > 21
    picks = {name: _is(item) for name, item in single.items()}
    picks["oxygen"] = _is(OXYGEN) & on_oxygen
    picks["oxygen_2"] = _is(OXYGEN_2) & on_oxygen
    wanted = _is(*single.values()) | (_is(OXYGEN, OXYGEN_2) & on_oxygen)
    return firsts_wide(score_measures(flow).where(wanted), picks)


def _suppox_points() -> Column:
    """2 when the first oxygen above room air starts no later than an hour after the first saturation.

    The first device decides when both report oxygen.  Null for an encounter without either.
    """
    start = F.coalesce(F.col("oxygen.t"), F.col("oxygen_2.t"))
    limit = F.col("spo2.t") + hours(1)
    known = start.isNotNull() | F.col("spo2").isNotNull()
    return F.when(known, F.when(start <= limit, 2).otherwise(0))


def _gcs_points(name: str, item: str) -> Column:
    return F.when(F.col(f"{name}.v") < fv.GCS_FULL[item], 3).when(F.col(f"{name}.v").isNotNull(), 0)


def _news_columns() -> dict[str, Column]:
    return {
        "news_resp": band_points(F.col("resp.v"), fv.NEWS_RESP),
        "news_spo2": band_points(F.col("spo2.v"), fv.NEWS_SPO2),
        "news_suppox": _suppox_points(),
        "news_temp": band_points(F.col("temp.v"), fv.NEWS_TEMP),
        "news_bp": band_points(F.col("bp.v"), fv.NEWS_SBP),
        "news_pulse": band_points(F.col("pulse.v"), fv.NEWS_PULSE),
        "news_consciousness": F.greatest(
            _gcs_points("eye", EYE), _gcs_points("verbal", VERBAL), _gcs_points("motor", MOTOR)
        ),
    }


def news_components(flow: DataFrame) -> DataFrame:
    """Band points of respiration, saturation (scale 1), temperature, pressure and pulse."""
    columns = _news_columns()
    shown = ["news_resp", "news_spo2", "news_temp", "news_bp", "news_pulse"]
    any_part = F.coalesce("resp", "spo2", "temp", "bp", "pulse").isNotNull()
    return _news_firsts(flow).where(any_part).select(KEY, *[columns[n].alias(n) for n in shown])


def news_suppox(flow: DataFrame) -> DataFrame:
    points = _news_columns()["news_suppox"].alias("news_suppox")
    return _news_firsts(flow).select(KEY, points).where(F.col("news_suppox").isNotNull())


def news_spo2_scale2(flow: DataFrame) -> DataFrame:
    """Saturation points for respiratory failure, which rise above 92 only on oxygen."""
    value = F.col("spo2.v")
    chain = F.when(value.isNull(), None)
    for limit, points in fv.NEWS_SPO2_SCALE2:
        chain = chain.when(value <= limit, points)
    chain = chain.when(_suppox_points() == 0, 0).otherwise(band_points(value, fv.NEWS_SPO2_SCALE2_ON_OXYGEN))
    return (
        _news_firsts(flow)
        .where(F.col("spo2").isNotNull())
        .select(KEY, value.alias("spo2"), chain.alias("news_spo2_scale2"))
    )


def news_consciousness(flow: DataFrame) -> DataFrame:
    """3 when the eye, verbal or motor response is below its full mark."""
    return (
        _news_firsts(flow)
        .where(F.coalesce("eye", "verbal", "motor").isNotNull())
        .select(
            KEY,
            _gcs_points("eye", EYE).alias("news_eye"),
            _gcs_points("verbal", VERBAL).alias("news_verbal"),
            _gcs_points("motor", MOTOR).alias("news_motor"),
            _news_columns()["news_consciousness"].alias("news_consciousness"),
        )
    )


def news_total(flow: DataFrame) -> DataFrame:
    """All NEWS2 parts and their sum, missing parts adding nothing."""
    columns = _news_columns()
    parts = _news_firsts(flow).select(KEY, *[c.alias(n) for n, c in columns.items()])
    return parts.withColumn("news_2_score", null_safe_sum(*[F.col(n) for n in columns]))
