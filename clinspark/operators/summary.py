"""Summaries of an extracted data set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.columns import resolve_column
from clinspark.functions.quantiles import numeric_profile
from clinspark.functions.scalars import minutes_between, n_pct
from clinspark.operators.windows import first_row

KEY = "encounterkey"
PATIENT = "patientdurablekey"


def numeric_summary(df: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    """Rows, missing, mean, sample deviation, minimum, quartiles and maximum of a column."""
    return numeric_profile(df, groups, column).withColumn("n", F.col("n") + F.col("missing"))


def cohort_overview(keys: DataFrame) -> DataFrame:
    """Patients, encounters, encounters per patient and the span of arrival dates."""
    counted = keys.agg(
        F.count_distinct(PATIENT).alias("n_patients"),
        F.count("*").alias("n_encounters"),
        F.min("arrivaldatekeyvalue").alias("first_date"),
        F.max("arrivaldatekeyvalue").alias("last_date"),
    )
    ratio = F.col("n_encounters") / F.when(F.col("n_patients") > 0, F.col("n_patients"))
    return counted.withColumn("encounters_per_patient", ratio).withColumn(
        "days", F.datediff("last_date", "first_date")
    )


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Rows per value and share of all rows, most frequent first; missing values only add to the total."""
    total = df.agg(F.count("*").alias("n")).scalar()
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )
    if k is not None:
        counts = counts.limit(k)
    return counts.withColumn("pct", n_pct(F.col("n"), total, 2))


def _one(df: DataFrame, value: Column) -> Column:
    """A single aggregate of a table as a value in another query."""
    return df.agg(value.alias("n")).scalar()


def _measures(spark, measures: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), n.alias("n"), total.alias("total"))
            for name, (n, total) in measures.items()
        ]
    )
    return (
        spark.range(1)
        .select(F.explode(rows).alias("m"))
        .select("m.measure", "m.n", "m.total", n_pct(F.col("m.n"), F.col("m.total"), 2).alias("pct"))
    )


def _dead(deaths: DataFrame) -> Column:
    """The patient of a registry row that has a date of death; of every row where the registry has no such column."""
    date = resolve_column(deaths, ["deathdate"])
    return F.col(PATIENT) if date is None else F.when(F.col(date).isNotNull(), F.col(PATIENT))


def outcome_rates(keys: DataFrame, admissions: DataFrame, icu: DataFrame, deaths: DataFrame) -> DataFrame:
    """Admission, intensive care and death rates, and intensive care among the admitted."""
    encounters = _one(keys, F.count("*"))
    admitted = _one(admissions, F.count_distinct(KEY))
    in_icu = _one(icu, F.count_distinct(KEY))
    died = _one(deaths, F.count_distinct(_dead(deaths)))
    patients = _one(keys, F.count_distinct(PATIENT))
    return _measures(
        keys.sparkSession,
        {
            "admitted": (admitted, encounters),
            "icu": (in_icu, encounters),
            "icu among admitted": (in_icu, admitted),
            "deaths": (died, patients),
        },
    )


def keyword_rates(df: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    """Rows whose text holds a word, for each word that occurs, and their share of all rows."""
    text = F.lower(column)
    counts = df.agg(
        F.count("*").alias("total"), *[F.count(F.when(text.contains(w), True)).alias(w) for w in words]
    )
    return (
        counts.unpivot("total", list(words), "keyword", "n")
        .where(F.col("n") > 0)
        .select("keyword", "n", n_pct(F.col("n"), F.col("total"), 2).alias("pct"))
    )


def hierarchy_cardinality(dx: DataFrame) -> DataFrame:
    """Events, distinct diagnoses and distinct names of every hierarchy level that has any.

    Events are first counted per distinct combination, so that counting ten columns distinctly works on
    the combinations and not on the events.
    """
    levels = [c for c in dx.columns if c.startswith("icd_l") and c.endswith("_name")]
    distinct = dx.groupBy("diagnosiskey", *levels).agg(F.count("*").alias("c"))
    counted = distinct.agg(
        F.sum("c").alias("events"),
        F.count_distinct("diagnosiskey").alias("diagnoses"),
        *[F.count_distinct(c).alias(c) for c in levels],
    )
    return counted.unpivot([], ["events", "diagnoses", *levels], "measure", "n").where(F.col("n") > 0)


def counts_per_name(df: DataFrame, name: str, k: int | None = None) -> DataFrame:
    """Rows and distinct encounters per name, most rows first."""
    counts = (
        df.where(F.col(name).isNotNull())
        .groupBy(F.col(name).alias("name"))
        .agg(F.count("*").alias("n"), F.count_distinct(KEY).alias("n_encounters"))
        .orderBy(F.desc("n"), "name")
    )
    return counts if k is None else counts.limit(k)


def top_medications(administrations: DataFrame, k: int = 15) -> DataFrame:
    """Doses and encounters of the medications given most."""
    return counts_per_name(administrations, "medicationname", k)


def time_to_treatment(
    administrations: DataFrame,
    visits: DataFrame,
    first_only: bool = False,
    time: str = "administrationinstant",
    arrival: str = "arrivalinstant",
) -> DataFrame:
    """Minutes from arrival to administration, over all doses or the first of each encounter."""
    doses = administrations.select(KEY, time)
    if first_only:
        doses = first_row(doses, [KEY], [time])
    joined = doses.join(visits.select(KEY, arrival), KEY, "left")
    return numeric_profile(
        joined.select(minutes_between(F.col(time), F.col(arrival)).alias("minutes")), [], "minutes"
    )


def coverage(tables: Mapping[str, DataFrame], keys: DataFrame) -> DataFrame:
    """Rows, distinct encounters and share of the cohort's encounters for each table."""
    total = _one(keys, F.count("*"))
    whole = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows"), F.count_distinct(KEY).alias("n_encounters")).select(
            F.lit(name).alias("table"), "n_rows", "n_encounters"
        )
        whole = row if whole is None else whole.unionByName(row)
    return whole.withColumn("pct", n_pct(F.col("n_encounters"), total, 2))


def imaging_coverage(imaging: DataFrame, keys: DataFrame) -> DataFrame:
    return coverage({"lung imaging": imaging}, keys)


def lab_availability(labs: DataFrame, keys: DataFrame, k: int = 20, name: str = "componentname") -> DataFrame:
    """The most frequent tests with results and encounters, and the share of the cohort they reach."""
    total = _one(keys, F.count("*"))
    return counts_per_name(labs, name, k).withColumn("pct", n_pct(F.col("n_encounters"), total, 2))


def marker_search(
    labs: DataFrame, markers: Mapping[str, Sequence[str]] = fv.LAB_MARKERS, name: str = "componentname"
) -> DataFrame:
    """Results and encounters of each marker by the first of its words that any test name holds.

    Words are looked for in the distinct test names, a small table, and the names found are joined back.
    """
    words = F.array(
        *[
            F.struct(F.lit(m).alias("marker"), F.lit(i).alias("position"), F.lit(w.lower()).alias("word"))
            for m, ws in markers.items()
            for i, w in enumerate(ws)
        ]
    )
    names = labs.select(F.col(name).alias("name")).where(F.col(name).isNotNull()).distinct()
    found = (
        names.select("name", F.explode(words).alias("w"))
        .where(F.contains(F.lower("name"), F.col("w.word")))
        .select("name", "w.marker", "w.position", "w.word")
    )
    best = found.groupBy("marker").agg(F.min("position").alias("position"))
    chosen = found.join(best, ["marker", "position"]).select("name", "marker", "word")
    return (
        labs.select(KEY, F.col(name).alias("name"))
        .join(chosen, "name")
        .groupBy("marker", "word")
        .agg(F.count("*").alias("n"), F.count_distinct(KEY).alias("n_encounters"))
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    whole = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        whole = row if whole is None else whole.unionByName(row)
    return whole


def completeness(tables: Mapping[str, DataFrame], fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """Present values of the listed fields as count and share of the rows of their table."""
    whole = None
    for name, columns in fields.items():
        counted = tables[name].agg(
            F.count("*").alias("total"), *[F.count(F.col(c)).alias(c) for c in columns]
        )
        part = counted.unpivot("total", list(columns), "field", "n").select(
            F.lit(name).alias("table"), "field", "n", "total", n_pct(F.col("n"), F.col("total"), 2).alias("pct")
        )
        whole = part if whole is None else whole.unionByName(part)
    return whole


#: Facts of the summary: which key they count by, and the name of their figure.
_BY_ENCOUNTER = {
    "admissions": "n_hospital_admissions", "icu": "n_icu_admissions", "antibiotics": "encounters_with_antibiotics",
    "vasopressors": "encounters_with_vasopressors",
}
_BY_ROW = {"labs": "lab_results", "assess": "flowsheet_assess_records", "resp": "flowsheet_resp_records", "imaging": "imaging_procedures"}


def dataset_summary(tables: Mapping[str, DataFrame | None], keys: DataFrame, extracted: bool = False) -> DataFrame:
    """One row of four structs: cohort, outcomes, treatments and data availability.

    ``tables`` may hold admissions, icu, deaths, antibiotics, vasopressors, labs, assess, resp and
    imaging, as whole facts or, with ``extracted``, as tables made by :mod:`clinspark.operators.extraction`; a table the site
    lacks counts zero.  Rows of other encounters and patients do not count.

    Keys and facts are stacked as narrow rows of (key, table) and counted once per key, combined before the one
    exchange.  An extract has the rows of a key as often as the cohort has the key, so rows of whole facts count that often.
    """
    encounter = F.struct(F.lit("e").alias("kind"), F.col(KEY).cast("string").alias("key"))
    patient = lambda value: F.struct(F.lit("p").alias("kind"), value.cast("string").alias("key"))
    row = lambda df, table, key: df.select(F.lit(table).alias("table"), key.alias("k")).select("table", "k.kind", "k.key")
    parts = [keys.select(F.lit("keys").alias("table"), F.explode(F.array(encounter, patient(F.col(PATIENT)))).alias("k")).select("table", "k.kind", "k.key")]
    for name, df in tables.items():
        if df is not None:
            parts.append(row(df, name, patient(_dead(df)) if name == "deaths" else encounter))
    names = ["keys", *_BY_ENCOUNTER, "deaths", *_BY_ROW]
    stacked = reduce(DataFrame.unionByName, parts)
    per_key = stacked.groupBy("kind", "key").agg(*[F.count(F.when(F.col("table") == n, True)).alias(n) for n in names]).where("keys > 0")
    is_encounter, known = F.col("kind") == "e", F.col("key").isNotNull()

    def keyed(test: Column) -> Column:
        return F.count(F.when(known & test, True))

    figures = {"n_patients": keyed(~is_encounter), "n_encounters": F.coalesce(F.sum(F.when(is_encounter, F.col("keys"))), F.lit(0))}
    figures |= {figure: keyed(is_encounter & (F.col(n) > 0)) for n, figure in _BY_ENCOUNTER.items()}
    figures |= {"n_deaths": keyed(~is_encounter & (F.col("deaths") > 0))}
    # a missing key joins nothing
    times = F.lit(1) if extracted else F.col("keys")
    figures |= {figure: F.coalesce(F.sum(F.when(is_encounter & known, times * F.col(n))), F.lit(0)) for n, figure in _BY_ROW.items()}
    counted = per_key.agg(*[value.cast("long").alias(figure) for figure, value in figures.items()])
    return counted.select(
        F.struct("n_patients", "n_encounters").alias("cohort"),
        F.struct("n_hospital_admissions", "n_icu_admissions", "n_deaths").alias("outcomes"),
        F.struct("encounters_with_antibiotics", "encounters_with_vasopressors").alias("treatments"),
        F.struct(*_BY_ROW.values()).alias("data_availability"),
    )
