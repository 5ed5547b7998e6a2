"""A site from its warehouse to its filtered cohort."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from clinspark.config import site_a
from clinspark.operators import extraction as ex
from clinspark.pipelines import combine_sites, extract_site, filter_site, site_extract, summarise_site
from clinspark.plans import load_all
from clinspark.plans.adapter import Warehouse
from clinspark.sources import tables as tb

load_all()
NEEDED = {
    "edvisitfact": "ed", "patientdim": "pt", "patientlocationeventfact": "loc", "departmentdim": "dept", "durationdim": "dur",
    "imagingfact": "img", "encounterfact": "enc", "diagnosisterminologydim": "term", "diagnosiseventfact": "dx",
    "hospitaladmissionfact": "adm", "coveragedim": "cov", "medicationadministrationfact": "mar", "medicationcodedim": "codes",
    "flowsheetvaluefact": "fs", "labcomponentresultfact": "lab",
}
OPTIONAL = {
    "icustayregistrydatamart": "icu", "patientdeathregistrydimx": "death", "socialdeterminantfact": "sdoh",
    "socialdeterminantanswerfact": "sdoh_answer", "socialdeterminantpatientdomainfact": "sdoh_domain",
}
ALWAYS = {
    "enc_keys", "pt_keys", "dur", "img_all_proc", "img_lung_proc", "img_lung", "enc", "enc_dx", "pt", "ed", "hosp_adm", "dx_enc_icd",
    "med_ab", "med_vp", "flowsheet_assess", "flowsheet_resp", "labs", "insurance", "lab_keys", "flowsheet_row_keys",
}
FILTERED = {
    "filtered_cohort", "filtered_cohort_hypotensive", "filtered_cbc_within_2h", "filtered_abnormal_temp_wbc",
    "filtered_chest_imaging", "filtered_hypotension", "cohort_attrition",
}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """The views as files: a site with the optional tables, and one without."""
    views, root = Warehouse(spark, "/root/testdata/sf0.001"), tmp_path_factory.mktemp("sites")
    for site, tables in (("full", NEEDED | OPTIONAL), ("plain", NEEDED)):
        for name, view in tables.items():
            views[view].write.parquet(str(root / site / name))
    return root


@pytest.mark.parametrize("site,has", [("full", True), ("plain", False)])
def test_extraction_and_filter(spark, warehouse, tmp_path, site, has):
    config = replace(site_a(str(warehouse / site)), ed_department="ED", has_icu_registry=has, has_death_registry=has, has_social_determinants=has)
    out, kept = str(tmp_path / "extracted"), str(tmp_path / "filtered")
    names = set(extract_site(spark, config, out, ("parquet",)))
    assert names == ALWAYS | ({"icu_reg", "death", "sdoh_fact", "sdoh_answer", "sdoh_domain"} if has else set())
    read = lambda name: spark.read.parquet(f"{out}/{name}.parquet")
    assert read("enc_keys").count() == 1205 and read("ed").count() == 1205
    assert set(filter_site(spark, out, kept)) == FILTERED
    for name in FILTERED:
        rows = spark.read.parquet(f"{kept}/{name}.parquet").count()
        assert rows > 0 and spark.read.option("header", True).csv(f"{kept}/{name}.csv").count() == rows
    assert spark.read.parquet(f"{kept}/filtered_cohort.parquet").count() == 643
    steps = {r["step"]: r["n"] for r in spark.read.parquet(f"{kept}/cohort_attrition.parquet").collect()}
    assert steps["0 extracted"] == 1205 and steps["6 cohort"] == 643
    summary = summarise_site(spark, out, kept).first()
    assert spark.read.json(f"{kept}/dataset_summary.json").count() == 1
    assert summary["cohort"]["n_encounters"] == 1205 and summary["data_availability"]["lab_results"] == read("labs").count()
    assert (summary["outcomes"]["n_deaths"] > 0) == has and summary["outcomes"]["n_hospital_admissions"] == read("hosp_adm").select("encounterkey").distinct().count()


def test_keys_are_evaluated_once(spark, warehouse, tmp_path, monkeypatch):
    """Locations decide on the keys alone, so what reads them evaluates the keys."""
    config = replace(site_a(str(warehouse / "full")), ed_department="ED")
    plans = {}
    write = tb.write_result

    def seen(frame, directory, name, formats):
        plans[name] = frame._jdf.queryExecution().optimizedPlan().toString(), frame.inputFiles()
        write(frame, directory, name, formats)

    monkeypatch.setattr("clinspark.pipelines.tb.write_result", seen)
    out = str(tmp_path / "out")
    made = extract_site(spark, config, out, ("parquet", "csv"))
    assert set(plans) == set(made)
    assert [n for n, (_, files) in plans.items() if any("patientlocationeventfact" in f for f in files)] == ["enc_keys"]
    # without stored keys nearly every table would
    lazy = site_extract(lambda name: spark.read.parquet(f"{config.path}/{name}"), config, spark)
    assert sum(any("patientlocationeventfact" in f for f in frame.inputFiles()) for frame in lazy.values()) > 10
    # the same rows as without them
    for name in ("enc_keys", "pt_keys", "labs", "flowsheet_assess", "dx_enc_icd", "death", "sdoh_domain", "img_lung_proc"):
        assert spark.read.parquet(f"{out}/{name}.parquet").exceptAll(lazy[name]).isEmpty() and spark.read.parquet(f"{out}/{name}.parquet").count() == lazy[name].count()
    with pytest.raises(ValueError, match="formats"):
        extract_site(spark, config, out, ("csv",))


def test_key_ranges_and_bloom_filters_reach_the_facts(spark, warehouse, tmp_path):
    keys = spark.createDataFrame([(5, 1, 2), (90, 1, 3)], "encounterkey long, patientkey long, patientdurablekey long")
    keys.write.parquet(str(tmp_path / "keys"))
    spark.range(0, 1000).select(F.col("id").alias("encounterkey"), F.rand(1).alias("v")).write.parquet(str(tmp_path / "facts"))
    stored = ex.key_ranges(spark.read.parquet(str(tmp_path / "keys")))
    assert stored.count() == 2 and ex.key_ranges(stored.limit(0)).count() == 0
    settings = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = ex.extract_by_key(spark.read.parquet(str(tmp_path / "facts")), stored)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["encounterkey"] for r in found.collect()) == [5, 90]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in plan
    assert re.search(r"PushedFilters: [^\n]*GreaterThanOrEqual\(encounterkey,5\)", plan) and re.search(r"LessThanOrEqual\(encounterkey,90\)", plan)


def test_sites_together(spark, warehouse, tmp_path):
    cohort = spark.range(3).select(F.col("id").alias("encounterkey"), F.lit(True).alias("has_hypotension"))
    for site in ("a", "b"):
        cohort.write.parquet(str(tmp_path / site / "filtered_cohort.parquet"))
    whole = combine_sites(spark, {s: str(tmp_path / s) for s in ("a", "b")}, str(tmp_path / "all"), ("parquet",))
    assert sorted(r["source_folder"] for r in whole.collect()) == ["a"] * 3 + ["b"] * 3
    assert spark.read.parquet(str(tmp_path / "all/filtered_cohort_combined.parquet")).count() == 6
