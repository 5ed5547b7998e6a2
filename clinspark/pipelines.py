"""A site's extraction and cohort filter from end to end, with the files they leave."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from clinspark.config import SiteConfig, configure
from clinspark.operators import cohort as co
from clinspark.operators import extraction as ex
from clinspark.operators import summary as sm
from clinspark.sources import mappings as mp
from clinspark.sources import tables as tb

FORMATS = ("parquet", "csv")


def site_keys(table: Callable[[str], DataFrame], site: SiteConfig) -> DataFrame:
    """The key rows of a site's cohort."""
    return ex.encounter_keys(table("edvisitfact"), table("patientdim"), table("patientlocationeventfact"), table("departmentdim"), site.ed_department)


def site_extract(
    table: Callable[[str], DataFrame], site: SiteConfig, spark: SparkSession, keys: DataFrame | None = None, patients: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every table of a site's extraction by name; ``table`` gives a warehouse table.

    The flags of the site say which optional tables it has.  Without the flag such a table is not asked for, and the
    extraction has no table of that name.  ``keys`` and ``patients`` should be stored tables, as nearly all others join
    them; without them each of the others evaluates the keys by itself.
    """
    visits = table("edvisitfact")
    keys = site_keys(table, site) if keys is None else keys
    patients = ex.patient_keys(keys) if patients is None else patients
    imaging, encounters = table("imagingfact"), table("encounterfact")
    terms, given = table("diagnosisterminologydim"), table("medicationadministrationfact")
    flowsheets, admissions = table("flowsheetvaluefact"), table("hospitaladmissionfact")
    optional = {
        "icu_reg": (site.has_icu_registry, lambda: ex.extract_by_key(table("icustayregistrydatamart"), keys)),
        "death": (site.has_death_registry, lambda: ex.death_rows(table("patientdeathregistrydimx"), keys)),
        "sdoh_fact": (site.has_social_determinants, lambda: ex.extract_by_key(table("socialdeterminantfact"), keys)),
        "sdoh_answer": (
            site.has_social_determinants,
            lambda: ex.sdoh_answers(table("socialdeterminantfact"), table("socialdeterminantanswerfact"), keys),
        ),
        "sdoh_domain": (
            site.has_social_determinants,
            lambda: ex.sdoh_domains(table("socialdeterminantpatientdomainfact"), patients),
        ),
    }
    return {
        "enc_keys": keys,
        "pt_keys": patients,
        "dur": ex.duration_dim(table("durationdim")),
        "img_all_proc": ex.imaging_summary(imaging, keys),
        "img_lung_proc": ex.imaging_match(imaging, keys, counts=True),
        "img_lung": ex.imaging_match(imaging, keys),
        "enc": ex.extract_by_key(encounters, keys),
        "enc_dx": ex.encounter_primary_dx(encounters, keys, terms),
        "pt": ex.extract_by_key(table("patientdim"), patients, "patientkey"),
        "ed": ex.extract_by_key(visits, keys.select("encounterkey")),
        "hosp_adm": ex.extract_by_key(admissions, keys.select("encounterkey")),
        "dx_enc_icd": ex.diagnosis_events(table("diagnosiseventfact"), keys.select("encounterkey"), terms, ordered=False),
        "med_ab": ex.meds_by_class(given, keys),
        "med_vp": ex.meds_by_name(table("medicationcodedim"), given, keys),
        "flowsheet_assess": ex.events_for_items(flowsheets, keys, list(site.assess_keys.values()), "flowsheetrowkey"),
        "flowsheet_resp": ex.events_for_items(flowsheets, keys, list(site.resp_keys.values()), "flowsheetrowkey"),
        "labs": ex.events_for_items(table("labcomponentresultfact"), keys, list(site.lab_keys.values()), "labcomponentkey"),
        "insurance": ex.insurance(table("coveragedim"), admissions, keys),
        "lab_keys": mp.item_keys(spark, site, "lab"),
        "flowsheet_row_keys": mp.item_keys(spark, site, "assess").unionByName(mp.item_keys(spark, site, "resp")),
    } | {name: build() for name, (has, build) in optional.items() if has}


def extract_site(spark: SparkSession, site: SiteConfig, directory: str, formats: Sequence[str] = FORMATS) -> list[str]:
    """Read a site's warehouse below ``site.path``, write every extracted table to ``directory``, return their names.

    The keys are evaluated once: their files are written first and all other tables join what is read from them.  ``formats`` needs
    one that keeps types, as text would not bring the same keys back.
    """
    typed = [form for form in formats if form in tb.TYPED_FORMATS]
    if not typed:
        raise ValueError(f"one of the formats must be of {tb.TYPED_FORMATS}")
    configure(spark)
    table = lambda name: spark.read.parquet(f"{site.path}/{name}")

    def kept(name: str, frame: DataFrame) -> DataFrame:
        tb.write_result(frame, directory, name, formats)
        return spark.read.schema(frame.schema).format(typed[0]).load(f"{directory}/{name}.{typed[0]}")

    keys = kept("enc_keys", site_keys(table, site))
    patients = kept("pt_keys", ex.patient_keys(keys))
    made = site_extract(table, site, spark, ex.key_ranges(keys), patients)
    for name, frame in made.items():
        if name not in ("enc_keys", "pt_keys"):
            tb.write_result(frame, directory, name, formats)
    return list(made)


def cohort_outputs(visits: DataFrame, labs: DataFrame, flowsheets: DataFrame, imaging: DataFrame) -> dict[str, DataFrame]:
    """The filtered cohort, its hypotensive part and the result of every criterion, by file name."""
    arrival = co.ed_arrival(visits)
    cbc = co.first_cbc_in_window(labs, arrival)
    cohort = co.filtered_cohort(visits, labs, flowsheets, imaging)
    return {
        "filtered_cohort": cohort,
        "filtered_cohort_hypotensive": co.hypotensive(cohort),
        "filtered_cbc_within_2h": cbc,
        "filtered_abnormal_temp_wbc": co.abnormal_temp_or_wbc(co.abnormal_temp(flowsheets, arrival), cbc),
        "filtered_chest_imaging": co.chest_imaging(imaging, arrival),
        "filtered_hypotension": co.hypotension(flowsheets, arrival),
    }


def filter_site(spark: SparkSession, extracted: str, directory: str, formats: Sequence[str] = FORMATS) -> list[str]:
    """Apply the cohort criteria to an extraction in ``extracted`` and write all results to ``directory``: the six tables, and
    how many encounters each step leaves (``cohort_attrition``)."""
    read = lambda name: spark.read.parquet(f"{extracted}/{name}.parquet")
    visits, inputs = read("ed"), (read("labs"), read("flowsheet_assess"), read("img_lung"))
    made = cohort_outputs(visits, *inputs)
    criteria = co.encounter_criteria(*inputs, co.ed_arrival(visits))
    made["cohort_attrition"] = co.attrition(visits, read("enc_keys"), criteria)
    for name, frame in made.items():
        tb.write_result(frame, directory, name, formats)
    return list(made)


#: Tables of an extraction that the summary counts, by their name there.
SUMMARISED = {
    "admissions": "hosp_adm", "icu": "icu_reg", "deaths": "death", "antibiotics": "med_ab", "vasopressors": "med_vp",
    "labs": "labs", "assess": "flowsheet_assess", "resp": "flowsheet_resp", "imaging": "img_lung",
}


def summarise_site(spark: SparkSession, extracted: str, directory: str) -> DataFrame:
    """The figures of an extraction in ``extracted`` as the JSON document ``dataset_summary.json`` in ``directory``.

    A table that the site does not have counts zero.
    """
    path = lambda name: f"{extracted}/{name}.parquet"
    tables = {part: spark.read.parquet(path(name)) if tb.path_exists(spark, path(name)) else None for part, name in SUMMARISED.items()}
    keys = spark.read.parquet(path("enc_keys"))
    # extracts have the rows of a key as often as the cohort has the key; each counts once
    summary = sm.dataset_summary(tables, keys, extracted=True)
    tb.write_json(summary, f"{directory}/dataset_summary.json")
    return summary


def combine_sites(spark: SparkSession, filtered: dict[str, str], directory: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """The filtered cohorts of several sites, ``{source: directory}``, as one, written to ``directory``."""
    cohorts = {source: spark.read.parquet(f"{path}/filtered_cohort.parquet") for source, path in filtered.items()}
    whole = tb.union_sites(cohorts, "source_folder")
    tb.write_result(whole, directory, "filtered_cohort_combined", formats)
    return whole
