"""Notebook cohort: SIRS inclusion, inclusion time, diagnosis flags and descriptive tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.quantiles import numeric_profile
from clinspark.functions.scalars import age_years, hours, n_pct, null_placeholders, null_safe_sum
from clinspark.operators.extraction import coded_terms
from clinspark.operators.severity import firsts_wide, lab_measures, score_measures, temp_flag, wbc_flag
from clinspark.operators.windows import first_row

KEY = "encounterkey"


def sirs_wbc(labs: DataFrame, arrival: DataFrame, window: float = 2) -> DataFrame:
    """First blood count; the flag needs it less than ``window`` hours after arrival, or before it."""
    counts = lab_measures(labs.where(F.col("componentname") == "WBC Count"))
    first = firsts_wide(counts, {"first": F.lit(True)})
    early = F.col("wbc_time") < F.col("ed_arrival_time") + hours(window)
    return (
        first.select(KEY, F.col("first.t").alias("wbc_time"), F.col("first.v").alias("wbc"))
        .join(arrival.select(KEY, "ed_arrival_time"), KEY, "left")
        .select(
            KEY, "wbc_time", "wbc",
            early.cast("int").alias("two_hours"),
            (early & (wbc_flag(F.col("wbc")) == 1)).cast("int").alias("sirs_wbc"),
        )
    )


def sirs_temp(flow: DataFrame) -> DataFrame:
    """First plausible temperature and its flag."""
    temps = score_measures(flow.where(F.col("item") == "Temp"))
    first = firsts_wide(temps, {"first": F.lit(True)})
    return first.select(
        KEY,
        F.col("first.t").alias("temp_time"),
        F.col("first.v").alias("temp"),
        temp_flag(F.col("first.v")).alias("sirs_temp"),
    )


def first_imaging_flag(
    imaging: DataFrame, arrival: DataFrame, time: str = "orderinginstant", window: float = 4
) -> DataFrame:
    """First image per encounter and whether it was ordered less than ``window`` hours after arrival."""
    first = first_row(imaging, [KEY], [time], ["firstprocedurename"])
    within = F.col(time) < F.col("ed_arrival_time") + hours(window)
    return first.join(arrival.select(KEY, "ed_arrival_time"), KEY, "left").select(
        KEY, F.col(time).alias("imaging_time"), "firstprocedurename", within.cast("int").alias("imaging")
    )


def sirs_inclusion(keys: DataFrame, wbc: DataFrame, temp: DataFrame) -> DataFrame:
    """Cohort rows with their flags; included when the flags add up to more than zero."""
    joined = keys.join(wbc, KEY, "left").join(temp, KEY, "left")
    summation = null_safe_sum(F.col("sirs_wbc"), F.col("sirs_temp"))
    return (
        joined.withColumn("analyzed", F.col("wbc").isNotNull() | F.col("temp").isNotNull())
        .withColumn("summation", summation)
        .withColumn("include", F.col("summation") > 0)
    )


def inclusion_timestamp(inclusion: DataFrame, at: float = 48, half: float = 4) -> DataFrame:
    """Time of the flag that included the encounter, the earlier of two, and the window after it."""
    chosen = (
        F.when(F.coalesce(F.col("sirs_temp"), F.lit(0)) == 0, F.col("wbc_time"))
        .when(F.coalesce(F.col("sirs_wbc"), F.lit(0)) == 0, F.col("temp_time"))
        .otherwise(F.least("wbc_time", "temp_time"))
    )
    included = inclusion.where("include").select(KEY, chosen.alias("inclusion_timestamp"))
    return window_around(included, at, half)


def window_around(inclusion: DataFrame, at: float = 48, half: float = 4) -> DataFrame:
    start = F.col("inclusion_timestamp")
    return (
        inclusion.withColumn("begin_timestamp", start + hours(at - half))
        .withColumn("midpoint_timestamp", start + hours(at))
        .withColumn("end_timestamp", start + hours(at + half))
    )


# --- diagnosis flags --------------------------------------------------------------------------------


def _any_level(levels: Sequence[int], test) -> Column:
    parts = [F.coalesce(test(F.lower(f"icd_l{level}_name")), F.lit(False)) for level in levels]
    return reduce(lambda a, b: a | b, parts)


def _names_sepsis(name: Column) -> Column:
    return name.rlike("sepsis|septic")


def _names_septic_shock(name: Column) -> Column:
    return _names_sepsis(name) & name.contains("shock") & ~name.contains("without")


def sepsis_codes(dx: DataFrame, levels: Sequence[int] = range(3, 7)) -> DataFrame:
    """Codes with sepsis in one of the hierarchy names."""
    return dx.where(_any_level(levels, _names_sepsis)).select("icd_value").distinct()


def septic_shock_codes(dx: DataFrame, levels: Sequence[int] = range(3, 8)) -> DataFrame:
    """Codes one of whose hierarchy names says sepsis and shock and not without."""
    return dx.where(_any_level(levels, _names_septic_shock)).select("icd_value").distinct()


def _code_flags(coded: DataFrame) -> DataFrame:
    """Per code, whether one of its rows has a name that says sepsis or septic shock."""
    return coded.groupBy("icd_value").agg(
        F.bool_or(_any_level(range(3, 7), _names_sepsis)).alias("sepsis"),
        F.bool_or(_any_level(range(3, 8), _names_septic_shock)).alias("septic_shock"),
    )


def dx_flags(dx: DataFrame, terms: DataFrame, keys: DataFrame) -> DataFrame:
    """Whether an encounter of the cohort has a sepsis or a septic shock code.

    A code counts for every event that carries it, whichever row of the terminology its name was found on.  The flags are
    made on the terminology, per code and then per diagnosis key, and the events, which are never shuffled by code,
    are joined once by that key.  An encounter without a coded diagnosis has no row.
    """
    coded = coded_terms(terms)
    per_key = (
        coded.select("diagnosiskey", "icd_value").distinct().join(_code_flags(coded), "icd_value")
        .groupBy("diagnosiskey")
        .agg(F.bool_or("sepsis").alias("sepsis"), F.bool_or("septic_shock").alias("septic_shock"))
    )
    return (
        dx.select(KEY, "diagnosiskey").join(keys.select(KEY), KEY, "left_semi").join(per_key, "diagnosiskey")
        .groupBy(KEY)
        .agg(F.bool_or("sepsis").alias("sepsis"), F.bool_or("septic_shock").alias("septic_shock"))
    )


# --- description of the included ----------------------------------------------------------------------


def patient_trim(
    patients: DataFrame, columns: Sequence[str], key: str = "patientdurablekey"
) -> DataFrame:
    """One row per patient with placeholder text nulled."""
    return null_placeholders(first_row(patients, [key], [], columns), [fv.UNKNOWN_TEXT])


def inclusion_groups(
    inclusion: DataFrame,
    flags: DataFrame,
    patients: DataFrame,
    imaging: DataFrame,
    ages: DataFrame | None = None,
) -> DataFrame:
    """Analysis table: flags, patient columns, age, and the group by inclusion and early imaging.

    ``ages`` may hold the recorded age per encounter, to compare with the computed one.
    """
    joined = inclusion.join(flags, KEY, "left").join(patients, "patientdurablekey", "left")
    joined = null_placeholders(joined, [fv.BLANK_TEXT])
    joined = joined.withColumn(
        "age", age_years(F.col("birthdate"), F.col("arrivaldatekeyvalue"), "days")
    )
    if ages is not None:
        joined = joined.join(ages.select(KEY, "durationage"), KEY, "left").withColumn(
            "age_delta", F.col("age") - F.col("durationage")
        )
    early = F.coalesce(F.col("imaging"), F.lit(0))
    group = (
        F.when(F.col("include") & (early == 1), "Suspected Sepsis with Imaging")
        .when(F.col("include"), "Suspected Sepsis No Imaging")
        .otherwise("No Suspected Sepsis")
    )
    return (
        joined.join(imaging.select(KEY, "imaging", "firstprocedurename"), KEY, "left")
        .withColumn("imaging", early)
        .withColumn("include_imaging", group)
        .withColumn("year", F.year("arrivaldatekeyvalue"))
    )


def table1(
    df: DataFrame, categorical: Sequence[str], continuous: Sequence[str], stratum: str
) -> DataFrame:
    """Level counts and numeric summaries per stratum, in long form.

    Every row is spread once into its levels and values, which are then counted; both parts come out of those
    counts.  A level is a group without values, and its rows are the missing ones.
    """
    none, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def cell(numeric: bool, name: str, level: Column, value: Column) -> Column:
        return F.struct(
            F.lit(numeric).alias("numeric"), F.lit(name).alias("variable"), level.alias("level"), value.alias("value")
        )

    cells = [cell(False, c, F.col(c).cast("string"), no_number) for c in categorical]
    cells += [cell(True, c, none, F.col(c).cast("double")) for c in continuous]
    rows = df.select(F.col(stratum).cast("string").alias("stratum"), F.explode(F.array(*cells)).alias("c"))
    profile = numeric_profile(rows.select("stratum", "c.*"), ["stratum", "numeric", "variable", "level"], "value")
    n = F.when(F.col("numeric"), F.col("n")).otherwise(F.col("missing"))
    known = F.when(F.col("level").isNotNull(), n)
    total = F.sum(known).over(Window.partitionBy("stratum", "numeric", "variable"))
    return profile.select(
        "stratum", "variable", "level", n.alias("n"),
        F.when(F.col("level").isNotNull(), n_pct(n, total, 2)).alias("pct"), "mean", "sd", "q25", "median", "q75",
    )


def visits_per_year(df: DataFrame, date: str = "arrivaldatekeyvalue") -> DataFrame:
    """Six-number summary of the yearly visit counts; there is one value per calendar year."""
    yearly = df.groupBy(F.year(date).alias("year")).agg(F.count("*").alias("n"))

    def quantile(p: float) -> Column:
        return F.percentile("n", p)

    return yearly.agg(
        F.count("*").alias("years"),
        F.min("n").alias("min"),
        quantile(0.25).alias("q25"),
        quantile(0.5).alias("median"),
        F.avg("n").alias("mean"),
        quantile(0.75).alias("q75"),
        F.max("n").alias("max"),
    )
