"""Cohort keys and the facts that belong to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.columns import resolve_column
from clinspark.functions.scalars import age_years, contains_any
from clinspark.operators.windows import first_n_per_group

LEVELS = range(1, 10)


def encounter_keys(
    visits: DataFrame,
    patients: DataFrame,
    locations: DataFrame,
    departments: DataFrame,
    department: str,
    min_age: int = fv.MIN_AGE,
) -> DataFrame:
    """Distinct key rows of adult visits that were located in the emergency department.

    Patients, locations and departments only decide which visits stay, so they are semi-joined and
    never multiply a visit.
    """
    in_department = locations.join(
        departments.where(F.col("departmentname") == department).select("departmentkey"),
        "departmentkey",
        "left_semi",
    )
    current = patients.where(F.col("iscurrent") == 1)
    is_adult = (visits["patientdurablekey"] == current["durablekey"]) & (
        age_years(current["birthdate"], visits["arrivaldatekeyvalue"]) >= min_age
    )
    # the join by encounter comes last, so that the keys are already dealt by encounter for what joins them
    return (
        visits.join(current, is_adult, "left_semi")
        .join(in_department.select("encounterkey"), "encounterkey", "left_semi")
        .select(
            "encounterkey", "patientkey", "patientdurablekey", "arrivaldatekeyvalue", "hospitaladmissionkey"
        )
        .distinct()
    )


def patient_keys(keys: DataFrame) -> DataFrame:
    return keys.select("patientdurablekey", "patientkey").distinct()


def duration_dim(durations: DataFrame, low: int = -99, high: int = 99) -> DataFrame:
    """Durations strictly between the limits."""
    return durations.where((F.col("years") > low) & (F.col("years") < high))


def key_ranges(keys: DataFrame) -> DataFrame:
    """``keys``, which should be a stored table, with the least and the largest encounter and patient as a condition.

    Only rows without encounter or patient go, which join nothing.  Catalyst carries the condition over each join to the facts, where
    it reaches the scan: row groups without a key of the cohort are not read.  It also makes the keys a side from which Spark
    builds a Bloom filter for large scans at run time (``configure`` sets the sizes).  Two pairs of numbers reach the driver.
    """
    columns = ("encounterkey", "patientdurablekey")
    ends = keys.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]).first()
    for c in columns:
        keys = keys.where(F.col(c).between(F.lit(ends[f"min_{c}"]), F.lit(ends[f"max_{c}"])))
    return keys


def extract_by_key(fact: DataFrame, keys: DataFrame | None, on: str = "encounterkey") -> DataFrame:
    """Fact rows of the cohort, all rows without ``keys``; a key that occurs twice brings its rows twice."""
    return fact if keys is None else fact.join(keys.select(on), on)


def extract_optional(fact: DataFrame | None, keys: DataFrame, on: str = "encounterkey") -> DataFrame | None:
    """As :func:`extract_by_key`, or nothing where the site has no such table."""
    return None if fact is None else extract_by_key(fact, keys, on)


def icd10_terms(terms: DataFrame) -> DataFrame:
    return terms.where(F.col("type") == "ICD-10-CM")


def _levels(terms: DataFrame) -> list[Column]:
    """The hierarchy columns the site has, renamed."""
    found = [(level, resolve_column(terms, [f"l{level}_name"])) for level in LEVELS]
    return [F.col(name).alias(f"icd_l{level}_name") for level, name in found if name]


def coded_terms(terms: DataFrame) -> DataFrame:
    """The terminology's ICD-10-CM codes by diagnosis key, with type and hierarchy names."""
    return icd10_terms(terms).select(
        "diagnosiskey", F.col("type").alias("icd_type"), F.col("value").alias("icd_value"), *_levels(terms)
    )


def encounter_primary_dx(encounters: DataFrame, keys: DataFrame, terms: DataFrame) -> DataFrame:
    """Encounters with their primary diagnosis; one row per code when a diagnosis has several."""
    coded = icd10_terms(terms).select(
        F.col("diagnosiskey").alias("primarydiagnosiskey"),
        F.col("value").alias("icd_value"),
        F.col("diagnosisname").alias("icd_diagnosisname"),
        F.col("displaystring").alias("icd_displaystring"),
        *_levels(terms),
    )
    return extract_by_key(encounters, keys).join(coded, "primarydiagnosiskey", "left")


def diagnosis_events(
    dx: DataFrame, keys: DataFrame, terms: DataFrame, ordered: bool = True
) -> DataFrame:
    """Diagnosis events of the cohort with code and hierarchy, in the order of the patient's history."""
    events = extract_by_key(dx, keys).join(coded_terms(terms), "diagnosiskey")
    if not ordered:
        return events
    sort = [
        c for c in ("patientdurablekey", "startdatekeyvalue", "diagnosiskey") if resolve_column(events, [c])
    ]
    return events.orderBy(*sort)


def death_rows(registry: DataFrame, keys: DataFrame, mode: str = "fanout") -> DataFrame:
    """Death registry rows: one per encounter (``fanout``) or one per patient (``semi``)."""
    how = {"fanout": "inner", "semi": "left_semi"}[mode]
    return registry.join(keys.select("patientdurablekey"), "patientdurablekey", how)


def insurance(coverage: DataFrame, admissions: DataFrame, keys: DataFrame) -> DataFrame:
    """Primary coverage of the cohort's admissions."""
    admitted = admissions.select("encounterkey", F.col("primarycoveragekey").alias("coveragekey"))
    return extract_by_key(admitted, keys).join(coverage, "coveragekey")


def sdoh_answers(facts: DataFrame, answers: DataFrame, keys: DataFrame) -> DataFrame:
    """Screening answers that belong to a screening of the cohort."""
    screened = extract_by_key(facts, keys).where(F.col("socialdeterminantkey").isNotNull())
    return answers.join(screened.select("socialdeterminantkey"), "socialdeterminantkey", "left_semi")


def sdoh_domains(domains: DataFrame, patients: DataFrame) -> DataFrame:
    return extract_by_key(domains, patients, "patientdurablekey")


def sdoh_top_domains(facts: DataFrame, keys: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent screening domains of the cohort."""
    return (
        extract_by_key(facts, keys)
        .where(F.col("socialdeterminantdomain").isNotNull())
        .groupBy("socialdeterminantdomain")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "socialdeterminantdomain")
        .limit(k)
    )


def _imaging_counts(imaging: DataFrame, keys: DataFrame) -> DataFrame:
    return (
        extract_by_key(imaging, keys)
        .groupBy("firstprocedurename", "firstprocedurecategory")
        .agg(F.count("*").alias("n"))
    )


def imaging_summary(
    imaging: DataFrame, keys: DataFrame, categories: Sequence[str] = fv.IMAGING_CATEGORIES
) -> DataFrame:
    """Procedures per name and category, in the listed categories."""
    return _imaging_counts(imaging.where(F.col("firstprocedurecategory").isin(list(categories))), keys)


def imaging_match(
    imaging: DataFrame, keys: DataFrame | None, words: Sequence[str] = fv.LUNG_WORDS, counts: bool = False
) -> DataFrame:
    """Procedures whose name holds one of the words: the rows, or counts per name and category."""
    matching = imaging.where(contains_any(F.lower("firstprocedurename"), words))
    return _imaging_counts(matching, keys) if counts else extract_by_key(matching, keys)


def meds_by_class(
    administrations: DataFrame, keys: DataFrame | None, therapeutic_class: str = fv.ANTIBIOTIC_CLASS
) -> DataFrame:
    return extract_by_key(
        administrations.where(F.col("medicationtherapeuticclass") == therapeutic_class), keys
    )


def meds_by_name(
    codes: DataFrame,
    administrations: DataFrame,
    keys: DataFrame | None,
    names: Sequence[str] = fv.VASOPRESSOR_NAMES,
    routes: Sequence[str] = fv.VASOPRESSOR_ROUTES,
) -> DataFrame:
    """Administrations of medications found by name and, where the site records it, by route."""
    wanted = codes.where(contains_any(F.upper("medicationname"), names))
    route = resolve_column(codes, ["medicationroute"])
    if route:
        wanted = wanted.where(F.lower(route).isin(list(routes)))
    wanted = wanted.select("medicationkey").distinct()
    return extract_by_key(administrations.join(wanted, "medicationkey", "left_semi"), keys)


def events_for_items(
    events: DataFrame, keys: DataFrame, items: Sequence[int], item: str
) -> DataFrame:
    """Events of the cohort for the listed item keys; the list is filtered in the scan."""
    return extract_by_key(events.where(F.col(item).isin(sorted(set(items)))), keys)


def first_values(
    events: DataFrame, keys: DataFrame, items: Sequence[int], item: str, order: Sequence[str], n: int = 5
) -> DataFrame:
    """The first ``n`` values per encounter and item."""
    return first_n_per_group(
        events_for_items(events, keys, items, item), ["encounterkey", item], order, n
    )
