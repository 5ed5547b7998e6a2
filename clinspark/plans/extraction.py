"""Queries: cohort keys, extraction joins and value normalisation."""

from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions import columns as c
from clinspark.functions import scalars as s
from clinspark.operators import extraction as x
from clinspark.operators import profile as p
from clinspark.plans.registry import query, shared

ED = fv.ED_DEPARTMENT_B


def keys(w):
    return x.encounter_keys(w["ed"], w["pt"], w["loc"], w["dept"], ED)


def in_list(values):
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


shared("keys", """
    SELECT DISTINCT ed.encounterkey, ed.patientkey, ed.patientdurablekey, ed.arrivaldatekeyvalue,
           ed.hospitaladmissionkey
    FROM {ed} JOIN {pt} ON pt.durablekey = ed.patientdurablekey
    JOIN {loc} ON loc.encounterkey = ed.encounterkey JOIN {dept} ON dept.departmentkey = loc.departmentkey
    WHERE date_diff('year', pt.birthdate, ed.arrivaldatekeyvalue) >= 18 AND pt.iscurrent = 1
      AND dept.departmentname = 'ED'""")
shared("ptkeys", "SELECT DISTINCT patientdurablekey, patientkey FROM {keys}")

LEVELS = ", ".join(f"t.l{i}_name AS icd_l{i}_name" for i in range(1, 10))


@query("encounter_keys", "SELECT * FROM {keys}")
def _(w):
    return keys(w)


@query("patient_keys", "SELECT * FROM {ptkeys}")
def _(w):
    return x.patient_keys(keys(w))


@query("range_filter", "SELECT * FROM {dur} WHERE years > -99 AND years < 99")
def _(w):
    return x.duration_dim(w["dur"])


@query("extract_by_encounter", "SELECT adm.* FROM {adm} JOIN {keys} USING (encounterkey)".replace(
    "adm.*", "encounterkey, adm.hospitaladmissionkey, primarycoveragekey, lengthofstayindays"))
def _(w):
    return x.extract_by_key(w["adm"], keys(w))


@query("extract_by_patient", """
    SELECT pt.* FROM {pt} JOIN {ptkeys} ON pt.patientkey = ptkeys.patientkey""")
def _(w):
    return x.extract_by_key(w["pt"], x.patient_keys(keys(w)), "patientkey")


@query("encounter_primary_dx", f"""
    SELECT enc.*, t.value AS icd_value, t.diagnosisname AS icd_diagnosisname,
           t.displaystring AS icd_displaystring, {LEVELS}
    FROM {{enc}} JOIN {{keys}} ON enc.encounterkey = keys.encounterkey
    LEFT JOIN {{term}} t ON enc.primarydiagnosiskey = t.diagnosiskey AND t.type = 'ICD-10-CM'""")
def _(w):
    return x.encounter_primary_dx(w["enc"], keys(w), w["term"])


shared("dxevents", f"""
    SELECT dx.*, t.type AS icd_type, t.value AS icd_value, {LEVELS}
    FROM {{dx}} JOIN {{keys}} ON dx.encounterkey = keys.encounterkey
    LEFT JOIN {{term}} t ON dx.diagnosiskey = t.diagnosiskey
    WHERE t.type = 'ICD-10-CM'""")


@query("diagnosis_events", "SELECT * FROM {dxevents}")
def _(w):
    return x.diagnosis_events(w["dx"], keys(w), w["term"])


@query("icu_rows", "SELECT icu.* FROM {icu} JOIN {keys} ON icu.encounterkey = keys.encounterkey")
def _(w):
    return x.extract_optional(w["icu"], keys(w))


@query("death_fanout", """
    SELECT death.* FROM {death} JOIN {keys} ON death.patientdurablekey = keys.patientdurablekey""")
def _(w):
    return x.death_rows(w["death"], keys(w))


@query("death_semi", """
    SELECT * FROM {death} WHERE patientdurablekey IN (SELECT patientdurablekey FROM {keys})""")
def _(w):
    return x.death_rows(w["death"], keys(w), "semi")


@query("insurance_join", """
    SELECT keys.encounterkey, CAST(cov.coveragekey AS BIGINT) AS coveragekey, payorfinancialclass, payorname
    FROM {cov} JOIN {adm} ON adm.primarycoveragekey = cov.coveragekey
    JOIN {keys} ON adm.encounterkey = keys.encounterkey""")
def _(w):
    return x.insurance(w["cov"], w["adm"], keys(w))


@query("sdoh_answers", """
    SELECT a.* FROM {sdoh_answer} a
    JOIN (SELECT DISTINCT socialdeterminantkey FROM {sdoh} JOIN {keys} USING (encounterkey)
          WHERE socialdeterminantkey IS NOT NULL) k
      ON a.socialdeterminantkey = k.socialdeterminantkey""")
def _(w):
    return x.sdoh_answers(w["sdoh"], w["sdoh_answer"], keys(w))


@query("sdoh_domains", """
    SELECT d.* FROM {sdoh_domain} d JOIN {ptkeys} k ON d.patientdurablekey = k.patientdurablekey""")
def _(w):
    return x.sdoh_domains(w["sdoh_domain"], x.patient_keys(keys(w)))


@query("sdoh_top_domains", """
    SELECT socialdeterminantdomain, count(*) AS n FROM {sdoh} JOIN {keys} USING (encounterkey)
    GROUP BY ALL ORDER BY n DESC, socialdeterminantdomain LIMIT 10""")
def _(w):
    return x.sdoh_top_domains(w["sdoh"], keys(w))


@query("imaging_summary", f"""
    SELECT firstprocedurename, firstprocedurecategory, count(*) AS n FROM {{img}} JOIN {{keys}} USING (encounterkey)
    WHERE firstprocedurecategory IN {in_list(fv.IMAGING_CATEGORIES)} GROUP BY ALL""")
def _(w):
    return x.imaging_summary(w["img"], keys(w))


LUNG = "(lower(firstprocedurename) LIKE '%chest%' OR lower(firstprocedurename) LIKE '%lung%')"
shared("lungimg", f"""
    SELECT img.* FROM {{img}} JOIN {{keys}} ON img.encounterkey = keys.encounterkey WHERE {LUNG}""")


@query("imaging_lung_proc", """
    SELECT firstprocedurename, firstprocedurecategory, count(*) AS n FROM {lungimg} GROUP BY ALL""")
def _(w):
    return x.imaging_match(w["img"], keys(w), counts=True)


@query("imaging_lung_rows", "SELECT * FROM {lungimg}")
def _(w):
    return x.imaging_match(w["img"], keys(w))


shared("abx", """
    SELECT mar.* FROM {mar} JOIN {keys} ON mar.encounterkey = keys.encounterkey
    WHERE medicationtherapeuticclass = 'ANTIBIOTICS'""")
PRESSOR_LIKE = " OR ".join(f"upper(medicationname) LIKE '%{n}%'" for n in fv.VASOPRESSOR_NAMES)
shared("pressors", f"""
    SELECT mar.* FROM {{mar}} JOIN {{keys}} ON mar.encounterkey = keys.encounterkey
    JOIN (SELECT DISTINCT medicationkey FROM {{codes}}
          WHERE ({PRESSOR_LIKE}) AND lower(medicationroute) IN ('intravenous', 'injection')) c
      ON mar.medicationkey = c.medicationkey""")


@query("meds_by_class", "SELECT * FROM {abx}")
def _(w):
    return x.meds_by_class(w["mar"], keys(w))


@query("meds_by_name", "SELECT * FROM {pressors}")
def _(w):
    return x.meds_by_name(w["codes"], w["mar"], keys(w))


@query("events_for_items", f"""
    SELECT fs.* FROM {{fs}} JOIN {{keys}} ON fs.encounterkey = keys.encounterkey
    WHERE flowsheetrowkey IN {in_list(fv.ASSESS_KEYS_A.values())}""")
def _(w):
    return x.events_for_items(w["fs"], keys(w), list(fv.ASSESS_KEYS_A.values()), "flowsheetrowkey")


@query("labs_for_items", f"""
    SELECT lab.* FROM {{lab}} JOIN {{keys}} ON lab.encounterkey = keys.encounterkey
    WHERE labcomponentkey IN {in_list(fv.LAB_KEYS_A.values())}""")
def _(w):
    return x.events_for_items(w["lab"], keys(w), list(fv.LAB_KEYS_A.values()), "labcomponentkey")


@query("first_n_values", f"""
    SELECT * FROM (
      SELECT lab.*, row_number() OVER (PARTITION BY lab.encounterkey, labcomponentkey
                                       ORDER BY resultinstant, value NULLS LAST) AS rn
      FROM {{lab}} JOIN {{keys}} ON lab.encounterkey = keys.encounterkey
      WHERE labcomponentkey IN {in_list(fv.LAB_KEYS_A.values())}) WHERE rn <= 5""")
def _(w):
    items = list(fv.LAB_KEYS_A.values())
    return x.first_values(w["lab"], keys(w), items, "labcomponentkey", ["resultinstant", "value"])


# --- scalar, time and value normalisation ---------------------------------------------------------


@query("time_resolution", """
    SELECT encounterkey, try_cast(CAST(arrivaldatekeyvalue AS STRING) || ' ' || arrivaltimeofdaykeyvalue AS TIMESTAMP) AS from_pair,
           arrivalinstant AS from_instant
    FROM {ed}""")
def _(w):
    ed = w["ed"]
    pair_only = ed.drop("arrivalinstant")
    return ed.select(
        "encounterkey",
        c.resolve_time(pair_only, fv.ARRIVAL_INSTANTS, fv.ARRIVAL_PAIRS).alias("from_pair"),
        c.resolve_time(ed, fv.ARRIVAL_INSTANTS, fv.ARRIVAL_PAIRS).alias("from_instant"),
    )


@query("numeric_parse", """
    SELECT encounterkey, componentname, value, try_cast(value AS DOUBLE) AS number FROM {lab2}""")
def _(w):
    lab = w["lab2"]
    return lab.select(
        "encounterkey", "componentname", "value", c.resolve_numeric(lab, fv.LAB_VALUES).alias("number")
    )


@query("bp_parse", """
    SELECT encounterkey, value, try_cast(split_part(value, '/', 1) AS DOUBLE) AS sbp
    FROM {fs} WHERE flowsheetrowkey = 32710""")
def _(w):
    return w["fs"].where("flowsheetrowkey = 32710").select(
        "encounterkey", "value", s.systolic(F.col("value")).alias("sbp")
    )


@query("bp_map", """
    SELECT encounterkey, value, try_cast(regexp_extract(value, '^[0-9]+') AS DOUBLE) AS sbp,
           try_cast(regexp_extract(value, '/([0-9]+)', 1) AS DOUBLE) AS dbp,
           round((sbp + 2 * dbp) / 3, 6) AS map
    FROM {vit} WHERE item = 'BP'""")
def _(w):
    top, bottom, mean = s.bp_parts(F.col("value"))
    return w["vit"].where("item = 'BP'").select(
        "encounterkey", "value", top.alias("sbp"), bottom.alias("dbp"), F.round(mean, 6).alias("map")
    )


@query("temp_normalise", """
    SELECT encounterkey, numericvalue,
           CASE WHEN x BETWEEN 32 AND 42 THEN round(x, 6) END AS celsius
    FROM (SELECT *, CASE WHEN numericvalue > 42 THEN (numericvalue - 32) * 5 / 9 ELSE numericvalue END AS x
          FROM {vit} WHERE item = 'Temp')""")
def _(w):
    return w["vit"].where("item = 'Temp'").select(
        "encounterkey", "numericvalue", F.round(s.normalise_temp(F.col("numericvalue")), 6).alias("celsius")
    )


@query("age_variants", """
    SELECT encounterkey, date_diff('year', birthdate, arrivaldatekeyvalue) AS age_calendar,
           round(date_diff('day', birthdate, arrivaldatekeyvalue) / 365.25, 6) AS age_days,
           round(date_diff('day', birthdate, arrivaldatekeyvalue) / 365.25
                 - date_diff('year', birthdate, arrivaldatekeyvalue), 6) AS age_delta
    FROM {ed} JOIN {pt} ON durablekey = patientdurablekey WHERE iscurrent = 1""")
def _(w):
    current = w["pt"].where("iscurrent = 1").select(F.col("durablekey").alias("patientdurablekey"), "birthdate")
    birth, at = F.col("birthdate"), F.col("arrivaldatekeyvalue")
    by_days, by_year = s.age_years(birth, at, "days"), s.age_years(birth, at)
    return w["ed"].join(current, "patientdurablekey").select(
        "encounterkey",
        by_year.cast("long").alias("age_calendar"),
        F.round(by_days, 6).alias("age_days"),
        F.round(by_days - by_year, 6).alias("age_delta"),
    )


@query("icd_normalise", """
    SELECT diagnosiskey, value, replace(value, '.', '') AS dots_only,
           trim(upper(replace(replace(value, '.', ''), ' ', ''))) AS spelled
    FROM {term_b}""")
def _(w):
    value = F.col("value")
    return w["term_b"].select(
        "diagnosiskey", "value", s.normalise_icd(value, "dots").alias("dots_only"),
        s.normalise_icd(value).alias("spelled"),
    )


@query("poa_flag", """
    SELECT encounterkey, presentonadmission, type,
           coalesce(lower(presentonadmission) = 'yes', false) OR type IN ('Medical History', 'Problem List') AS poa
    FROM {dx}""")
def _(w):
    return w["dx"].select(
        "encounterkey", "presentonadmission", "type",
        s.poa_qualified(F.col("presentonadmission"), F.col("type")).alias("poa"),
    )


@query("null_placeholders", """
    SELECT patientkey,
           CASE WHEN NOT (firstrace ILIKE '%unknown%' OR firstrace ILIKE '%decline%' OR firstrace LIKE '*%'
                          OR firstrace = '' OR firstrace = 'Missing') THEN firstrace END AS firstrace,
           CASE WHEN NOT (ethnicity ILIKE '%unknown%' OR ethnicity ILIKE '%decline%' OR ethnicity LIKE '*%'
                          OR ethnicity = '' OR ethnicity = 'Missing') THEN ethnicity END AS ethnicity
    FROM {pt}""")
def _(w):
    people = w["pt"].select("patientkey", "firstrace", "ethnicity")
    return s.null_placeholders(people, [fv.UNKNOWN_TEXT, fv.BLANK_TEXT])


@query("unparseable_census", """
    SELECT value, count(*) AS n FROM {lab2}
    WHERE value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL GROUP BY value""")
def _(w):
    return p.unparseable_census(w["lab2"], "value")


@query("accepted_only", "SELECT * FROM {vit} WHERE accepted = 1 AND numericvalue IS NOT NULL")
def _(w):
    return p.accepted_only(w["vit"], "numericvalue", "accepted")
