"""Queries: covariate ranking, diagnosis classes, data set summaries and item profiles."""

from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.scalars import icu_flag
from clinspark.operators import covariates as cv
from clinspark.operators import diagnosis as dg
from clinspark.operators import extraction as x
from clinspark.operators import profile as p
from clinspark.operators import summary as sm
from clinspark.plans.extraction import in_list, keys
from clinspark.plans.registry import query, shared
from clinspark.plans.severity import dx_events
from clinspark.plans.comorbidity import values_sql

# --- covariates ---------------------------------------------------------------------------------------

# raw names by slot, some with a concept and some without
RAW = {
    "lab": ["WBC Count", "Creatinine", "Creatinine, Serum", "Urea Nitrogen", "BUN", "Lactate, plasma", "Ferritin"],
    "assess": ["PULSE", "PULSE OXIMETRY", "R ZSFG PULSE FROM SPO2", "RESPIRATIONS", "ED RASS", "MOOD SCALE"],
    "resp": ["R FIO2", "R FIO2 2", "R RT VENT MODE", "R IP VENT MODE", "SPARE ROW"],
}
SITES = {"site_a": "l_orderkey % 3 <> 0", "site_b": "l_orderkey % 3 = 0"}
TABLES = {"lab": "l_linenumber <= 4", "assess": "l_linenumber > 4", "resp": "l_linenumber = 2"}


def raw_sql(kind, site):
    names = RAW[kind]
    return (
        f"SELECT l_orderkey AS encounterkey, {names}[CAST(l_partkey % {len(names)} AS INT) + 1] AS raw_name "
        f"FROM {{lineitem}} WHERE {TABLES[kind]} AND {SITES[site]}"
    )


STATS = "\nUNION ALL ".join(
    f"SELECT raw_name, '{data_type}' AS data_type, '{site}' AS site, count(*) AS records, "
    f"count(DISTINCT encounterkey) AS encounters FROM ({raw_sql(kind, site)}) GROUP BY raw_name"
    for site in SITES for kind, data_type in zip(RAW, cv.DATA_TYPES)
)
shared("cov_stats", STATS)
shared("concept_map", values_sql(
    [(raw, concept) for concept, names in fv.CONCEPTS.items() for raw in names], "raw_name, concept"))
shared("cov_mapped", """
    SELECT s.*, coalesce(m.concept, s.raw_name) AS concept FROM {cov_stats} s
    LEFT JOIN {concept_map} m ON s.raw_name = m.raw_name""")
shared("cov_table", """
    SELECT concept, first(data_type ORDER BY site, CASE data_type WHEN 'Laboratory' THEN 1 WHEN 'Vital Signs' THEN 2 ELSE 3 END) AS data_type,
           {cols}, sum(records)::BIGINT AS total_records, sum(encounters)::BIGINT AS total_encounters
    FROM {cov_mapped} GROUP BY concept""".replace("{cols}", ", ".join(
    f"coalesce(string_agg(DISTINCT raw_name, '; ' ORDER BY raw_name) FILTER (WHERE site = '{s}'), '') AS {s}_names, "
    f"coalesce(sum(records) FILTER (WHERE site = '{s}'), 0)::BIGINT AS {s}_records, "
    f"coalesce(sum(encounters) FILTER (WHERE site = '{s}'), 0)::BIGINT AS {s}_encounters" for s in SITES)))


def raw_stats(w):
    def events(kind, site):
        names = F.array(*[F.lit(n) for n in RAW[kind]])
        column = "componentname" if kind == "lab" else "flowsheetrowname"
        return w["lineitem"].where(TABLES[kind]).where(SITES[site]).select(
            F.col("l_orderkey").alias("encounterkey"),
            F.element_at(names, (F.col("l_partkey") % len(RAW[kind])).cast("int") + 1).alias(column),
        )

    parts = [cv.site_raw_stats(site, *[events(kind, site) for kind in RAW]) for site in SITES]
    return parts[0].unionByName(parts[1])


@query("covariate_raw_stats", "SELECT * FROM {cov_stats}")
def _(w):
    return raw_stats(w)


@query("covariate_concepts", "SELECT * FROM {cov_mapped}")
def _(w):
    return cv.map_concepts(raw_stats(w))


@query("covariate_table", "SELECT * FROM {cov_table}")
def _(w):
    return cv.covariate_table(raw_stats(w), list(SITES))


@query("covariate_top_n", """
    SELECT *, row_number() OVER (ORDER BY total_records DESC, concept) AS rank FROM {cov_table}
    ORDER BY total_records DESC, concept LIMIT 5""")
def _(w):
    return cv.covariate_top_n(cv.covariate_table(raw_stats(w), list(SITES)), 5)


# --- diagnosis classes -----------------------------------------------------------------------------------


def starts(column, prefixes):
    return "(" + " OR ".join(f"{column} LIKE '{x}%'" for x in prefixes) + ")"


def has(column, words):
    return "(" + " OR ".join(f"{column} LIKE '%{x}%'" for x in words) + ")"


def mentions(word):
    return f"(txt LIKE '%{word}%' AND NOT regexp_matches(txt, 'WITHOUT\\b.*\\b{word}'))"


def class_sql(source, code, name, l1, l2, l3, keep):
    """The classes as a CASE over upper-case code ``c``, name ``nm`` and joined text ``txt``."""
    cases = [
        (starts("c", fv.DX_EXCLUDED_CODES), "NULL"),
        (f"{starts('c', fv.DX_SEPSIS_CODES)} OR (nm NOT LIKE '%ASEPTIC%' AND {has('nm', fv.DX_SEPSIS_WORDS)})",
         "'sepsis_bacteremia'"),
        (f"{starts('c', fv.DX_RESPIRATORY_CODES)} OR (txt LIKE '%PNEUMONIA%' AND txt NOT LIKE '%CRYPTOGENIC%') "
         "OR txt LIKE '%EMPYEMA%'", "'infection_respiratory'"),
        (f"{starts('c', fv.DX_URINARY_CODES)} OR {has('txt', fv.DX_URINARY_WORDS)}", "'infection_urinary'"),
        (f"{starts('c', fv.DX_ABDOMINAL_CODES)} OR {has('txt', fv.DX_ABDOMINAL_WORDS)}", "'infection_abdominal'"),
        (f"{starts('c', fv.DX_SKIN_CODES)} OR {has('txt', fv.DX_SKIN_WORDS)} OR {mentions('ABSCESS')} "
         f"OR ({mentions('GANGRENE')} AND NOT {starts('c', fv.DX_VASCULAR_CODES)})", "'infection_skin'"),
        (starts("c", fv.DX_NONBACTERIAL_CODES), "NULL"),
        (f"{starts('c', fv.DX_OTHER_CODES)} OR (txt NOT LIKE '%NONPYOGENIC%' AND {has('txt', fv.DX_OTHER_WORDS)})",
         "'infection_other'"),
        (f"{starts('c', fv.DX_SHOCK_CODES)} OR nm LIKE '%SHOCK%'", "'shock'"),
        (f"{starts('c', fv.DX_ORGAN_CODES)} OR c IN {in_list(fv.DX_ORGAN_EXACT_CODES)} OR {has('txt', fv.DX_ORGAN_WORDS)} "
         "OR regexp_matches(txt, '\\b(DIC|ARDS)\\b')", "'organ_dysfunction'"),
        (f"{starts('c', fv.DX_FEVER_CODES)} OR (nm LIKE '%FEVER%' AND nm NOT LIKE '%WITHOUT FEVER%')", "'fever'"),
    ]
    case = "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in cases) + " END"
    return f"""
    SELECT {keep}, {case} AS sepsis_category FROM (
      SELECT *, c || ' ' || nm || ' ' || coalesce(upper({l1}), '') || ' ' || coalesce(upper({l2}), '') || ' '
                || coalesce(upper({l3}), '') AS txt
      FROM (SELECT *, coalesce(upper({code}), '') AS c, coalesce(upper({name}), '') AS nm FROM {source}))"""


@query("sepsis_category", class_sql(
    "{term}", "value", "diagnosisname", "l1_name", "l2_name", "l3_name", "diagnosiskey, value, diagnosisname"))
def _(w):
    category = dg.sepsis_category(
        *[F.col(c) for c in ("value", "diagnosisname", "l1_name", "l2_name", "l3_name")]
    )
    return w["term"].select("diagnosiskey", "value", "diagnosisname", category.alias("sepsis_category"))


shared("code_counts", """
    SELECT icd_value, (SELECT diagnosisname FROM {dxevents} i WHERE i.icd_value = o.icd_value AND diagnosisname IS NOT NULL
                       GROUP BY diagnosisname ORDER BY count(*) DESC, diagnosisname LIMIT 1) AS diagnosisname,
           count(*) AS count, min(icd_type) AS icd_type, min(icd_l1_name) AS icd_l1_name,
           min(icd_l2_name) AS icd_l2_name, min(icd_l3_name) AS icd_l3_name
    FROM {dxevents} o GROUP BY icd_value""")
shared("top_codes", class_sql(
    "{code_counts}", "icd_value", "diagnosisname", "icd_l1_name", "icd_l2_name", "icd_l3_name",
    "icd_value, diagnosisname, count, icd_type, icd_l1_name, icd_l2_name, icd_l3_name"))


def all_codes(w):
    return dg.top_icd_codes(dx_events(w), None)


@query("top_icd_codes", "SELECT * FROM {top_codes} ORDER BY count DESC, icd_value LIMIT 5000")
def _(w):
    return dg.top_icd_codes(dx_events(w))


# a list shorter than there are codes, and the classes in that list
shared("top_ten", "SELECT * FROM {top_codes} ORDER BY count DESC, icd_value LIMIT 10")


@query("category_counts_top10", "SELECT sepsis_category, count(*) AS n FROM {top_ten} WHERE sepsis_category IS NOT NULL GROUP BY ALL")
def _(w):
    return dg.category_counts(dg.top_icd_codes(dx_events(w), 10))


@query("category_counts", """
    SELECT sepsis_category, count(*) AS n FROM {top_codes} WHERE sepsis_category IS NOT NULL GROUP BY ALL""")
def _(w):
    return dg.category_counts(all_codes(w))


@query("top_codes_per_category", """
    SELECT * FROM (SELECT sepsis_category, icd_value, diagnosisname, count,
                          row_number() OVER (PARTITION BY sepsis_category ORDER BY count DESC, icd_value) AS rank
                   FROM {top_codes} WHERE sepsis_category IS NOT NULL) WHERE rank <= 5""")
def _(w):
    return dg.top_codes_per_category(all_codes(w))


ICU = "coalesce(" + has("upper(departmentname)", fv.ICU_WORDS) + " OR regexp_matches(upper(departmentname), '[0-9]+\\s*(ICU|ICC)'), false)"


@query("icu_flag", f"SELECT encounterkey, departmentname, {ICU} AS is_icu FROM {{enc}}")
def _(w):
    return w["enc"].select("encounterkey", "departmentname", icu_flag(F.col("departmentname")).alias("is_icu"))


@query("department_counts", f"""
    SELECT departmentname, count(*) AS count, min(departmentspecialty) AS departmentspecialty, {ICU} AS is_icu
    FROM {{dxevents}} JOIN {{enc}} USING (encounterkey) WHERE departmentname IS NOT NULL GROUP BY departmentname""")
def _(w):
    return dg.department_counts(dx_events(w).join(w["enc"], "encounterkey"))


# --- summaries ------------------------------------------------------------------------------------------------

shared("k_adm", "SELECT adm.* FROM {adm} JOIN {keys} ON adm.encounterkey = keys.encounterkey")
shared("k_icu", "SELECT icu.* FROM {icu} JOIN {keys} ON icu.encounterkey = keys.encounterkey")
shared("k_death", "SELECT death.* FROM {death} JOIN {keys} ON death.patientdurablekey = keys.patientdurablekey")
shared("k_dead", "SELECT * FROM {k_death} WHERE deathdate IS NOT NULL")
shared("k_pt", "SELECT pt.* FROM {pt} JOIN {ptkeys} ON pt.patientkey = ptkeys.patientkey")


def admissions(w):
    return x.extract_by_key(w["adm"], keys(w))


def rounded(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


NUMBERS = ("mean", "sd", "min", "q25", "median", "q75", "max")


def summary_sql(column):
    return f"""count(*) AS n, count(*) - count({column}) AS missing, round(avg({column}), 6) AS mean,
        round(stddev_samp({column}), 6) AS sd, round(min({column}), 6) AS min,
        round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS median,
        round(quantile_cont({column}, 0.75), 6) AS q75, round(max({column}), 6) AS max"""


@query("numeric_summary", f"SELECT {summary_sql('lengthofstayindays')} FROM {{k_adm}}")
def _(w):
    return rounded(sm.numeric_summary(admissions(w), "lengthofstayindays"), *NUMBERS)


@query("numeric_summary_nan", f"""
    SELECT {summary_sql('v')} FROM (SELECT CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity AS DOUBLE) END AS v FROM {{lineitem}})""")
def _(w):
    measured = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double"))
    return rounded(sm.numeric_summary(w["lineitem"].select(measured.alias("v")), "v"), *NUMBERS)


@query("numeric_summary_by_type", f"SELECT event_type, {summary_sql('value')} FROM {{events}} GROUP BY event_type")
def _(w):
    return rounded(sm.numeric_summary(w["events"], "value", ["event_type"]), *NUMBERS)


@query("cohort_overview", """
    SELECT count(DISTINCT patientdurablekey) AS n_patients, count(*) AS n_encounters, min(arrivaldatekeyvalue) AS first_date,
           max(arrivaldatekeyvalue) AS last_date, round(count(*) / count(DISTINCT patientdurablekey), 6) AS encounters_per_patient,
           date_diff('day', min(arrivaldatekeyvalue), max(arrivaldatekeyvalue)) AS days
    FROM {keys}""")
def _(w):
    return rounded(sm.cohort_overview(keys(w)), "encounters_per_patient")


def counts_sql(source, column, limit=""):
    return f"""
        SELECT {column} AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM {source}), 2) AS pct
        FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY n DESC, value {limit}"""


@query("value_counts", counts_sql("{k_pt}", "firstrace", "LIMIT 10"))
def _(w):
    patients = x.extract_by_key(w["pt"], x.patient_keys(keys(w)), "patientkey")
    return sm.value_counts(patients, "firstrace", 10)


shared("k_ins", """
    SELECT payorfinancialclass, payorname FROM {cov} JOIN {adm} ON adm.primarycoveragekey = cov.coveragekey
    JOIN {keys} ON adm.encounterkey = keys.encounterkey""")


@query("payor_counts", counts_sql("{k_ins}", "payorfinancialclass"))
def _(w):
    return sm.value_counts(x.insurance(w["cov"], w["adm"], keys(w)), "payorfinancialclass")


@query("outcome_rates", """
    SELECT *, round(100.0 * n / total, 2) AS pct FROM (
      SELECT 'admitted' AS measure, (SELECT count(DISTINCT encounterkey) FROM {k_adm}) AS n, (SELECT count(*) FROM {keys}) AS total
      UNION ALL SELECT 'icu', (SELECT count(DISTINCT encounterkey) FROM {k_icu}), (SELECT count(*) FROM {keys})
      UNION ALL SELECT 'icu among admitted', (SELECT count(DISTINCT encounterkey) FROM {k_icu}),
                       (SELECT count(DISTINCT encounterkey) FROM {k_adm})
      UNION ALL SELECT 'deaths', (SELECT count(DISTINCT patientdurablekey) FROM {k_dead}),
                       (SELECT count(DISTINCT patientdurablekey) FROM {keys}))""")
def _(w):
    k = keys(w)
    return sm.outcome_rates(k, admissions(w), x.extract_by_key(w["icu"], k), x.death_rows(w["death"], k))


WORDS = [*fv.SEPSIS_WORDS, *fv.LUNG_DX_WORDS]
shared("encdx", """
    SELECT t.diagnosisname AS icd_diagnosisname FROM {enc} JOIN {keys} ON enc.encounterkey = keys.encounterkey
    LEFT JOIN {term} t ON enc.primarydiagnosiskey = t.diagnosiskey AND t.type = 'ICD-10-CM'""")


@query("keyword_rates", "SELECT keyword, n, round(100.0 * n / (SELECT count(*) FROM {encdx}), 2) AS pct FROM ("
       + " UNION ALL ".join(
           f"SELECT '{x}' AS keyword, count(*) AS n FROM {{encdx}} WHERE icd_diagnosisname ILIKE '%{x}%'" for x in WORDS)
       + ") WHERE n > 0")
def _(w):
    primary = x.encounter_primary_dx(w["enc"], keys(w), w["term"])
    return sm.keyword_rates(primary, "icd_diagnosisname", WORDS)


@query("hierarchy_cardinality", "SELECT * FROM (SELECT 'events' AS measure, count(*) AS n FROM {dxevents} "
       "UNION ALL SELECT 'diagnoses', count(DISTINCT diagnosiskey) FROM {dxevents} UNION ALL "
       + " UNION ALL ".join(
           f"SELECT 'icd_l{i}_name', count(DISTINCT icd_l{i}_name) FROM {{dxevents}}" for i in range(1, 10))
       + ") WHERE n > 0")
def _(w):
    return sm.hierarchy_cardinality(dx_events(w))


def antibiotics(w):
    return x.meds_by_class(w["mar"], keys(w))


def vasopressors(w):
    return x.meds_by_name(w["codes"], w["mar"], keys(w))


@query("top_medications", """
    SELECT medicationname AS name, count(*) AS n, count(DISTINCT encounterkey) AS n_encounters
    FROM {abx} GROUP BY medicationname ORDER BY n DESC, name LIMIT 15""")
def _(w):
    return sm.top_medications(antibiotics(w))


@query("vasopressor_types", """
    SELECT medicationname AS name, count(*) AS n, count(DISTINCT encounterkey) AS n_encounters
    FROM {pressors} GROUP BY medicationname""")
def _(w):
    return sm.counts_per_name(vasopressors(w), "medicationname")


MINUTES = "date_diff('microsecond', arrivalinstant, administrationinstant) / 6e7"


def timing_sql(source):
    return f"""
        SELECT {summary_sql('m').replace('count(*) AS n', 'count(m) AS n', 1)}
        FROM (SELECT {MINUTES} AS m FROM {source} d LEFT JOIN {{ed}} e ON d.encounterkey = e.encounterkey)"""


@query("time_to_treatment", timing_sql("{abx}"))
def _(w):
    return rounded(sm.time_to_treatment(antibiotics(w), w["ed"]), *NUMBERS)


@query("time_to_first_treatment", timing_sql(
    "(SELECT encounterkey, min(administrationinstant) AS administrationinstant FROM {pressors} GROUP BY encounterkey)"))
def _(w):
    return rounded(sm.time_to_treatment(vasopressors(w), w["ed"], first_only=True), *NUMBERS)


@query("imaging_coverage", """
    SELECT 'lung imaging' AS table, count(*) AS n_rows, count(DISTINCT encounterkey) AS n_encounters,
           round(100.0 * count(DISTINCT encounterkey) / (SELECT count(*) FROM {keys}), 2) AS pct FROM {lungimg}""")
def _(w):
    return sm.imaging_coverage(x.imaging_match(w["img"], keys(w)), keys(w))


shared("k_lab2", "SELECT lab2.* FROM {lab2} JOIN {keys} ON lab2.encounterkey = keys.encounterkey")
shared("k_vit", "SELECT vit.* FROM {vit} JOIN {keys} ON vit.encounterkey = keys.encounterkey")
shared("k_resp", "SELECT resp.* FROM {resp} JOIN {keys} ON resp.encounterkey = keys.encounterkey")


@query("data_coverage", " UNION ALL ".join(
    f"SELECT '{name}' AS table, count(*) AS n_rows, count(DISTINCT encounterkey) AS n_encounters, "
    f"round(100.0 * count(DISTINCT encounterkey) / (SELECT count(*) FROM {{keys}}), 2) AS pct FROM {{{source}}}"
    for name, source in (("labs", "k_lab2"), ("assess", "k_vit"), ("resp", "k_resp"))))
def _(w):
    k = keys(w)
    tables = {"labs": w["lab2"], "assess": w["vit"], "resp": w["resp"]}
    return sm.coverage({name: x.extract_by_key(df, k) for name, df in tables.items()}, k)


@query("lab_availability", """
    SELECT componentname AS name, count(*) AS n, count(DISTINCT encounterkey) AS n_encounters,
           round(100.0 * count(DISTINCT encounterkey) / (SELECT count(*) FROM {keys}), 2) AS pct
    FROM {k_lab2} GROUP BY componentname ORDER BY n DESC, name LIMIT 20""")
def _(w):
    return sm.lab_availability(x.extract_by_key(w["lab2"], keys(w)), keys(w))


def marker_sql():
    parts = []
    for marker, words in fv.LAB_MARKERS.items():
        tests = [f"EXISTS (SELECT 1 FROM {{k_lab2}} WHERE componentname ILIKE '%{w}%')" for w in words]
        chosen = "CASE " + " ".join(f"WHEN {t} THEN '{w.lower()}'" for t, w in zip(tests, words)) + " END"
        parts.append(f"SELECT '{marker}' AS marker, {chosen} AS word")
    return f"""
        SELECT marker, word, count(*) AS n, count(DISTINCT encounterkey) AS n_encounters
        FROM ({" UNION ALL ".join(parts)}) m JOIN {{k_lab2}} ON contains(lower(componentname), word) GROUP BY marker, word"""


@query("marker_search", marker_sql())
def _(w):
    return sm.marker_search(x.extract_by_key(w["lab2"], keys(w)))


FIELDS = {"pt": ["sex", "firstrace", "birthdate"], "ed": ["arrivalinstant", "dischargedisposition", "departureinstant"]}


@query("completeness", " UNION ALL ".join(
    f"SELECT '{t}' AS table, '{f}' AS field, count({f}) AS n, count(*) AS total, "
    f"round(100.0 * count({f}) / count(*), 2) AS pct FROM {{{t}}}" for t, fields in FIELDS.items() for f in fields))
def _(w):
    return sm.completeness({name: w[name] for name in FIELDS}, FIELDS)


SIZED = ["pt", "ed", "adm", "dx", "mar", "lab2", "vit"]


@query("table_sizes", " UNION ALL ".join(f"SELECT '{t}' AS table, count(*) AS n FROM {{{t}}}" for t in SIZED))
def _(w):
    return sm.table_sizes({name: w[name] for name in SIZED})


SUMMARY = {
    "n_patients": "count(DISTINCT patientdurablekey) FROM {keys}",
    "n_encounters": "count(*) FROM {keys}",
    "n_hospital_admissions": "count(DISTINCT encounterkey) FROM {k_adm}",
    "n_icu_admissions": "count(DISTINCT encounterkey) FROM {k_icu}",
    "n_deaths": "count(DISTINCT patientdurablekey) FROM {k_dead}",
    "encounters_with_antibiotics": "count(DISTINCT encounterkey) FROM {abx}",
    "encounters_with_vasopressors": "count(DISTINCT encounterkey) FROM {pressors}",
    "lab_results": "count(*) FROM {k_lab2}",
    "flowsheet_assess_records": "count(*) FROM {k_vit}",
    "flowsheet_resp_records": "count(*) FROM {k_resp}",
    "imaging_procedures": "count(*) FROM {lungimg}",
}


@query("dataset_summary", "SELECT " + ", ".join(f"(SELECT {sql}) AS {name}" for name, sql in SUMMARY.items()))
def _(w):
    facts = {
        "admissions": w["adm"],
        "icu": w["icu"],
        "deaths": w["death"],
        "antibiotics": x.meds_by_class(w["mar"], None),
        "vasopressors": x.meds_by_name(w["codes"], w["mar"], None),
        "labs": w["lab2"],
        "assess": w["vit"],
        "resp": w["resp"],
        "imaging": x.imaging_match(w["img"], None),
    }
    summary = sm.dataset_summary(facts, keys(w))
    return summary.select("cohort.*", "outcomes.*", "treatments.*", "data_availability.*")


# --- item profiles -------------------------------------------------------------------------------------------


@query("item_search", """
    SELECT item, count(*) AS n FROM {vit} WHERE lower(item) LIKE '%temp%' OR lower(item) LIKE '%bp%'
        OR lower(item) LIKE '%best%response%' GROUP BY item ORDER BY n DESC, item LIMIT 20""")
def _(w):
    return p.item_search(w["vit"], "item", ["%temp%", "%bp%", "%best%response%"], ["item"])


@query("top_items", """
    SELECT labcomponentkey, count(*) AS n FROM {lab} GROUP BY labcomponentkey ORDER BY n DESC, labcomponentkey LIMIT 30""")
def _(w):
    return p.top_items(w["lab"], ["labcomponentkey"])


@query("profile_table", """
    SELECT c AS column, t AS type, (SELECT count(*) FROM {lab2}) AS n_rows
    FROM (VALUES ('encounterkey', 'bigint'), ('ts', 'timestamp_ntz'), ('componentname', 'string'), ('value', 'string')) AS x(c, t)""")
def _(w):
    return p.profile_table(w["lab2"])
