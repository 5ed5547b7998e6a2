"""Queries: SIRS, NEWS2, notebook inclusion, eSOFA and descriptive tables."""

from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.operators import esofa as es
from clinspark.operators import inclusion as inc
from clinspark.operators import severity as sv
from clinspark.operators.extraction import diagnosis_events, meds_by_name
from clinspark.plans.cohort import arrival, lung_images
from clinspark.plans.extraction import in_list, keys
from clinspark.plans.registry import query, shared

CELSIUS = "CASE WHEN numericvalue > 42 THEN (numericvalue - 32) * 5 / 9 ELSE numericvalue END"
shared("acc", "SELECT * FROM {vit} WHERE accepted = 1")
shared("labnum", "SELECT encounterkey, componentname, ts, try_cast(value AS DOUBLE) AS v, value FROM {lab2}")


def first_of(source, value, where):
    return (
        f"SELECT encounterkey, ts, v FROM (SELECT encounterkey, ts, {value} AS v, row_number() OVER "
        f"(PARTITION BY encounterkey ORDER BY ts, {value} NULLS LAST) AS rn FROM {source} WHERE {where}) WHERE rn = 1"
    )


def first_numeric(item, extra="true"):
    return first_of("{acc}", "numericvalue", f"item = '{item}' AND numericvalue IS NOT NULL AND {extra}")


shared("f_resp", first_numeric("Resp"))
shared("f_spo2", first_numeric("SpO2"))
shared("f_pulse", first_numeric("Pulse"))
shared("f_eye", first_numeric("Best Eye Response"))
shared("f_verbal", first_numeric("Best Verbal Response"))
shared("f_motor", first_numeric("Best Motor Response (upper extremities)"))
shared("f_oxygen", first_numeric("FiO2 (%)", "numericvalue > 21"))
shared("f_temp", first_of("{acc}", CELSIUS, f"item = 'Temp' AND {CELSIUS} BETWEEN 32 AND 42"))
shared("f_bp", first_of(
    "{acc}", "try_cast(regexp_extract(value, '^[0-9]+') AS DOUBLE)", "item = 'BP' AND value <> ''"))
shared("f_wbc", first_of("{labnum}", "v", "componentname = 'WBC Count' AND v IS NOT NULL"))


@query("first_value_per_item", """
    SELECT encounterkey, item, ts, numericvalue FROM (
      SELECT *, row_number() OVER (PARTITION BY encounterkey, item ORDER BY ts, numericvalue) AS rn
      FROM {acc} WHERE numericvalue IS NOT NULL) WHERE rn = 1""")
def _(w):
    return sv.first_value_per_item(w["vit"].where("accepted = 1"))


@query("sirs_score", """
    SELECT coalesce(t.encounterkey, p.encounterkey, r.encounterkey, b.encounterkey) AS encounterkey,
           CAST(t.v > 38 OR t.v < 36 AS INT) AS sirs_temp, CAST(p.v > 90 AS INT) AS sirs_pulse,
           CAST(r.v > 20 AS INT) AS sirs_resp_rate, CAST(b.v > 12 OR b.v < 4 AS INT) AS sirs_wbc,
           coalesce(sirs_temp, 0) + coalesce(sirs_pulse, 0) + coalesce(sirs_resp_rate, 0)
             + coalesce(sirs_wbc, 0) AS sirs_score
    FROM {f_temp} t FULL JOIN {f_pulse} p ON t.encounterkey = p.encounterkey
    FULL JOIN {f_resp} r ON coalesce(t.encounterkey, p.encounterkey) = r.encounterkey
    FULL JOIN {f_wbc} b ON coalesce(t.encounterkey, p.encounterkey, r.encounterkey) = b.encounterkey""")
def _(w):
    return sv.sirs_score(w["vit"], w["lab2"])


shared("news_parts", """
    SELECT encounterkey, max(resp) AS resp, max(spo2) AS spo2, max(spo2_t) AS spo2_t, max(temp) AS temp,
           max(bp) AS bp, max(has_bp) AS has_bp, max(pulse) AS pulse, max(eye) AS eye, max(verbal) AS verbal,
           max(motor) AS motor, max(oxygen_t) AS oxygen_t
    FROM (SELECT encounterkey, v AS resp FROM {f_resp}
          UNION ALL BY NAME SELECT encounterkey, v AS spo2, ts AS spo2_t FROM {f_spo2}
          UNION ALL BY NAME SELECT encounterkey, v AS temp FROM {f_temp}
          UNION ALL BY NAME SELECT encounterkey, v AS bp, 1 AS has_bp FROM {f_bp}
          UNION ALL BY NAME SELECT encounterkey, v AS pulse FROM {f_pulse}
          UNION ALL BY NAME SELECT encounterkey, v AS eye FROM {f_eye}
          UNION ALL BY NAME SELECT encounterkey, v AS verbal FROM {f_verbal}
          UNION ALL BY NAME SELECT encounterkey, v AS motor FROM {f_motor}
          UNION ALL BY NAME SELECT encounterkey, ts AS oxygen_t FROM {f_oxygen})
    GROUP BY encounterkey""")
NEWS = {
    "news_resp": "CASE WHEN resp <= 8 THEN 3 WHEN resp <= 11 THEN 1 WHEN resp <= 20 THEN 0 WHEN resp <= 24 THEN 2 "
                 "WHEN resp >= 25 THEN 3 END",
    "news_spo2": "CASE WHEN spo2 <= 91 THEN 3 WHEN spo2 <= 93 THEN 2 WHEN spo2 <= 95 THEN 1 WHEN spo2 > 95 THEN 0 END",
    "news_suppox": "CASE WHEN oxygen_t IS NULL AND spo2_t IS NULL THEN NULL "
                   "WHEN oxygen_t <= spo2_t + INTERVAL 1 HOUR THEN 2 ELSE 0 END",
    "news_temp": "CASE WHEN temp <= 35 THEN 3 WHEN temp <= 36 THEN 1 WHEN temp <= 38 THEN 0 WHEN temp <= 39 THEN 1 "
                 "WHEN temp > 39 THEN 2 END",
    "news_bp": "CASE WHEN bp <= 90 THEN 3 WHEN bp <= 100 THEN 2 WHEN bp <= 110 THEN 1 WHEN bp <= 219 THEN 0 "
               "WHEN bp > 219 THEN 3 END",
    "news_pulse": "CASE WHEN pulse <= 40 THEN 3 WHEN pulse <= 50 THEN 1 WHEN pulse <= 90 THEN 0 WHEN pulse <= 110 THEN 1 "
                  "WHEN pulse <= 130 THEN 2 WHEN pulse > 130 THEN 3 END",
    "news_consciousness": "greatest(CASE WHEN eye < 4 THEN 3 WHEN eye >= 4 THEN 0 END, "
                          "CASE WHEN verbal < 5 THEN 3 WHEN verbal >= 5 THEN 0 END, "
                          "CASE WHEN motor < 6 THEN 3 WHEN motor >= 6 THEN 0 END)",
}


def news_sql(*names):
    return ", ".join(f"{NEWS[n]} AS {n}" for n in names)


@query("news_components", f"""
    SELECT encounterkey, {news_sql("news_resp", "news_spo2", "news_temp", "news_bp", "news_pulse")}
    FROM {{news_parts}} WHERE coalesce(resp, spo2, temp, has_bp, pulse) IS NOT NULL""")
def _(w):
    return sv.news_components(w["vit"])


@query("news_spo2_scale2", f"""
    SELECT encounterkey, spo2, CASE WHEN spo2 <= 83 THEN 3 WHEN spo2 <= 85 THEN 2 WHEN spo2 <= 87 THEN 1
        WHEN spo2 <= 92 THEN 0 WHEN ({NEWS["news_suppox"]}) = 0 THEN 0 WHEN spo2 <= 94 THEN 1
        WHEN spo2 <= 96 THEN 2 WHEN spo2 >= 97 THEN 3 END AS news_spo2_scale2
    FROM {{news_parts}} WHERE spo2 IS NOT NULL""")
def _(w):
    return sv.news_spo2_scale2(w["vit"])


@query("news_suppox", f"""
    SELECT * FROM (SELECT encounterkey, {news_sql("news_suppox")} FROM {{news_parts}}) WHERE news_suppox IS NOT NULL""")
def _(w):
    return sv.news_suppox(w["vit"])


@query("news_consciousness", f"""
    SELECT encounterkey, CASE WHEN eye < 4 THEN 3 WHEN eye >= 4 THEN 0 END AS news_eye,
           CASE WHEN verbal < 5 THEN 3 WHEN verbal >= 5 THEN 0 END AS news_verbal,
           CASE WHEN motor < 6 THEN 3 WHEN motor >= 6 THEN 0 END AS news_motor, {news_sql("news_consciousness")}
    FROM {{news_parts}} WHERE coalesce(eye, verbal, motor) IS NOT NULL""")
def _(w):
    return sv.news_consciousness(w["vit"])


@query("news_total", f"""
    SELECT *, {" + ".join(f"coalesce({n}, 0)" for n in NEWS)} AS news_2_score
    FROM (SELECT encounterkey, {news_sql(*NEWS)} FROM {{news_parts}})""")
def _(w):
    return sv.news_total(w["vit"])


# --- inclusion -----------------------------------------------------------------------------------------

shared("s_wbc", """
    SELECT b.encounterkey, b.ts AS wbc_time, b.v AS wbc,
           CAST(b.ts < arrivalinstant + INTERVAL 2 HOUR AS INT) AS two_hours,
           CAST(b.ts < arrivalinstant + INTERVAL 2 HOUR AND (b.v > 12 OR b.v < 4) AS INT) AS sirs_wbc
    FROM {f_wbc} b LEFT JOIN {visits} e ON b.encounterkey = e.encounterkey""")
shared("s_temp", """
    SELECT encounterkey, ts AS temp_time, v AS temp, CAST(v > 38 OR v < 36 AS INT) AS sirs_temp FROM {f_temp}""")
shared("s_img", """
    SELECT i.encounterkey, i.ts AS imaging_time, i.v AS firstprocedurename,
           CAST(i.ts < arrivalinstant + INTERVAL 4 HOUR AS INT) AS imaging
    FROM {f_img} i LEFT JOIN {visits} e ON i.encounterkey = e.encounterkey""")
shared("f_img", """
    SELECT encounterkey, orderinginstant AS ts, firstprocedurename AS v FROM (
      SELECT *, row_number() OVER (PARTITION BY encounterkey ORDER BY orderinginstant, firstprocedurename) AS rn
      FROM {lungall}) WHERE rn = 1""")
shared("incl", """
    SELECT k.*, wbc_time, wbc, two_hours, sirs_wbc, temp_time, temp, sirs_temp,
           wbc IS NOT NULL OR temp IS NOT NULL AS analyzed,
           coalesce(sirs_wbc, 0) + coalesce(sirs_temp, 0) AS summation,
           coalesce(sirs_wbc, 0) + coalesce(sirs_temp, 0) > 0 AS include
    FROM {keys} k LEFT JOIN {s_wbc} b ON k.encounterkey = b.encounterkey
    LEFT JOIN {s_temp} t ON k.encounterkey = t.encounterkey""")
shared("incl_time", """
    SELECT encounterkey, t AS inclusion_timestamp, t + INTERVAL 44 HOUR AS begin_timestamp,
           t + INTERVAL 48 HOUR AS midpoint_timestamp, t + INTERVAL 52 HOUR AS end_timestamp
    FROM (SELECT encounterkey, CASE WHEN sirs_temp IS NULL OR sirs_temp = 0 THEN wbc_time
                                    WHEN sirs_wbc IS NULL OR sirs_wbc = 0 THEN temp_time
                                    WHEN wbc_time < temp_time THEN wbc_time ELSE temp_time END AS t
          FROM {incl} WHERE include)""")


def inclusion(w):
    return inc.sirs_inclusion(keys(w), inc.sirs_wbc(w["lab2"], arrival(w)), inc.sirs_temp(w["vit"]))


def window(w):
    return inc.inclusion_timestamp(inclusion(w))


@query("sirs_wbc_2h", "SELECT * FROM {s_wbc}")
def _(w):
    return inc.sirs_wbc(w["lab2"], arrival(w))


@query("imaging_4h", "SELECT * FROM {s_img}")
def _(w):
    return inc.first_imaging_flag(lung_images(w), arrival(w))


@query("sirs_inclusion", "SELECT * FROM {incl}")
def _(w):
    return inclusion(w)


@query("inclusion_timestamp", "SELECT * FROM {incl_time}")
def _(w):
    return window(w)


# --- eSOFA -----------------------------------------------------------------------------------------------


def baseline_sql(names):
    return first_of("{labnum}", "v", f"componentname IN {in_list(names)}")


shared("b_creat", baseline_sql(fv.ESOFA_CREATININE))
shared("b_bili", baseline_sql(fv.ESOFA_BILIRUBIN))
shared("b_plt", baseline_sql(fv.ESOFA_PLATELET))
shared("labwin", """
    SELECT l.*, l.ts > begin_timestamp AND l.ts < end_timestamp AS inside
    FROM {labnum} l JOIN {incl_time} t ON l.encounterkey = t.encounterkey""")
shared("e_lact", """
    SELECT DISTINCT encounterkey, 1 AS flag FROM {labwin} WHERE inside AND componentname = 'Lactate, plasma' AND v >= 2""")
shared("e_creat", f"""
    SELECT DISTINCT l.encounterkey, 1 AS flag FROM {{labwin}} l JOIN {{b_creat}} b ON l.encounterkey = b.encounterkey
    WHERE inside AND componentname IN {in_list(fv.ESOFA_CREATININE)} AND l.v >= b.v * 2""")
shared("e_bili", """
    SELECT DISTINCT l.encounterkey, 1 AS flag FROM {labwin} l JOIN {b_bili} b ON l.encounterkey = b.encounterkey
    WHERE inside AND componentname = 'Bilirubin, Total' AND l.v >= b.v * 2 AND l.v >= 2""")
shared("e_plt", """
    SELECT DISTINCT l.encounterkey, 1 AS flag FROM {labwin} l JOIN {b_plt} b ON l.encounterkey = b.encounterkey
    WHERE inside AND componentname = 'Platelet Count' AND b.v >= 100 AND l.v < 100 AND b.v / 2 >= l.v""")
shared("e_pressor", """
    SELECT DISTINCT m.encounterkey, 1 AS flag FROM {pressors} m JOIN {incl_time} t ON m.encounterkey = t.encounterkey
    WHERE administrationinstant < midpoint_timestamp""")
shared("e_vent", f"""
    SELECT DISTINCT r.encounterkey, 1 AS flag FROM {{resp}} r JOIN {{incl_time}} t ON r.encounterkey = t.encounterkey
    WHERE flowsheetrowname IN {in_list(fv.VENTILATION_ROWS)} AND ts < midpoint_timestamp""")
shared("esofa", """
    SELECT t.*, p.flag AS esofa_pressor, m.flag AS esofa_mv, l.flag AS esofa_lactate, c.flag AS esofa_creatinine,
           b.flag AS esofa_bilirubin, s.flag AS esofa_platelet,
           coalesce(p.flag, 0) + coalesce(m.flag, 0) + coalesce(l.flag, 0) + coalesce(c.flag, 0)
             + coalesce(b.flag, 0) + coalesce(s.flag, 0) AS esofa_count,
           CASE WHEN esofa_count > 0 THEN 1 ELSE 0 END AS esofa_binary
    FROM {incl_time} t LEFT JOIN {e_pressor} p ON t.encounterkey = p.encounterkey
    LEFT JOIN {e_vent} m ON t.encounterkey = m.encounterkey LEFT JOIN {e_lact} l ON t.encounterkey = l.encounterkey
    LEFT JOIN {e_creat} c ON t.encounterkey = c.encounterkey LEFT JOIN {e_bili} b ON t.encounterkey = b.encounterkey
    LEFT JOIN {e_plt} s ON t.encounterkey = s.encounterkey""")


def pressor_events(w):
    return meds_by_name(w["codes"], w["mar"], keys(w))


def organ_events(w):
    """Vasopressor and ventilation events of all encounters; the window they are joined to holds the cohort's."""
    pressors = meds_by_name(w["codes"], w["mar"], None).select("encounterkey", F.col("administrationinstant").alias("ts"))
    ventilation = w["resp"].where(F.col("flowsheetrowname").isin(fv.VENTILATION_ROWS)).select("encounterkey", "ts")
    return pressors, ventilation


def esofa(w):
    return es.esofa(window(w), *organ_events(w), w["lab2"])


@query("esofa", "SELECT * FROM {esofa}")
def _(w):
    return esofa(w)


@query("esofa_pressor", """
    SELECT m.encounterkey, min(administrationinstant) AS first_time, 1 AS esofa_pressor
    FROM {pressors} m JOIN {incl_time} t ON m.encounterkey = t.encounterkey
    WHERE administrationinstant < midpoint_timestamp GROUP BY m.encounterkey""")
def _(w):
    return es.esofa_pressor(pressor_events(w), window(w))


@query("esofa_vent", f"""
    SELECT r.encounterkey, min(ts) AS first_time, 1 AS esofa_mv
    FROM {{resp}} r JOIN {{incl_time}} t ON r.encounterkey = t.encounterkey
    WHERE flowsheetrowname IN {in_list(fv.VENTILATION_ROWS)} AND ts < midpoint_timestamp GROUP BY r.encounterkey""")
def _(w):
    return es.esofa_vent(w["resp"], window(w))


@query("lab_baseline", """
    SELECT coalesce(c.encounterkey, p.encounterkey) AS encounterkey, c.v AS creatinine, p.v AS platelet
    FROM {b_creat} c FULL JOIN (SELECT * FROM {b_plt} WHERE v >= 100) p ON c.encounterkey = p.encounterkey""")
def _(w):
    creatinine = es.lab_baseline(w["lab2"], fv.ESOFA_CREATININE, "creatinine")
    platelet = es.lab_baseline(w["lab2"], fv.ESOFA_PLATELET, "platelet", 100)
    return creatinine.join(platelet, "encounterkey", "full")


@query("esofa_labs", """
    SELECT t.encounterkey, c.v AS baseline_creatinine, b.v AS baseline_bilirubin, p.v AS baseline_platelet,
           l1.flag AS esofa_lactate, l2.flag AS esofa_creatinine, l3.flag AS esofa_bilirubin, l4.flag AS esofa_platelet
    FROM (SELECT DISTINCT encounterkey FROM {labwin} WHERE componentname IN
           ('Lactate, plasma', 'Creatinine', 'Creatinine, Serum', 'Bilirubin, Total', 'Platelet Count')) t
    LEFT JOIN {b_creat} c ON t.encounterkey = c.encounterkey LEFT JOIN {b_bili} b ON t.encounterkey = b.encounterkey
    LEFT JOIN {b_plt} p ON t.encounterkey = p.encounterkey LEFT JOIN {e_lact} l1 ON t.encounterkey = l1.encounterkey
    LEFT JOIN {e_creat} l2 ON t.encounterkey = l2.encounterkey LEFT JOIN {e_bili} l3 ON t.encounterkey = l3.encounterkey
    LEFT JOIN {e_plt} l4 ON t.encounterkey = l4.encounterkey""")
def _(w):
    return es.esofa_vs_baseline(w["lab2"], window(w))


# --- diagnosis flags and descriptive tables -----------------------------------------------------------------


def any_level(levels, test):
    return " OR ".join(f"coalesce({test.format(n=f'lower(icd_l{i}_name)')}, false)" for i in levels)


SEPSIS = any_level(range(3, 7), "({n} LIKE '%sepsis%' OR {n} LIKE '%septic%')")
SHOCK = any_level(
    range(3, 8), "(({n} LIKE '%sepsis%' OR {n} LIKE '%septic%') AND {n} LIKE '%shock%' AND {n} NOT LIKE '%without%')"
)
shared("c_sepsis", f"SELECT DISTINCT icd_value FROM {{dxevents}} WHERE {SEPSIS}")
shared("c_shock", f"SELECT DISTINCT icd_value FROM {{dxevents}} WHERE {SHOCK}")
shared("dxflags", """
    SELECT encounterkey, bool_or(icd_value IN (SELECT icd_value FROM {c_sepsis})) AS sepsis,
           bool_or(icd_value IN (SELECT icd_value FROM {c_shock})) AS septic_shock
    FROM {dxevents} GROUP BY encounterkey""")


def dx_events(w):
    return diagnosis_events(w["dx"], keys(w), w["term"], ordered=False)


def dx_flags(w):
    return inc.dx_flags(w["dx"], w["term"], keys(w))


@query("sepsis_codes", "SELECT * FROM {c_sepsis}")
def _(w):
    return inc.sepsis_codes(dx_events(w))


@query("septic_shock_codes", "SELECT * FROM {c_shock}")
def _(w):
    return inc.septic_shock_codes(dx_events(w))


@query("dx_flags", "SELECT * FROM {dxflags}")
def _(w):
    return dx_flags(w)


def unknown(column):
    return f"CASE WHEN NOT ({column} ILIKE '%unknown%' OR {column} ILIKE '%decline%') THEN {column} END"


shared("pttrim", f"""
    SELECT patientdurablekey, birthdate, {unknown("sex")} AS sex, {unknown("firstrace")} AS firstrace,
           {unknown("ethnicity")} AS ethnicity
    FROM (SELECT *, durablekey AS patientdurablekey,
                 row_number() OVER (PARTITION BY durablekey ORDER BY birthdate, sex, firstrace, ethnicity) AS rn
          FROM {{pt}}) WHERE rn = 1""")


def patients(w):
    renamed = w["pt"].withColumnRenamed("durablekey", "patientdurablekey")
    return inc.patient_trim(renamed, ["birthdate", "sex", "firstrace", "ethnicity"])


@query("patient_trim", "SELECT * FROM {pttrim}")
def _(w):
    return patients(w)


def blank(column):
    return f"CASE WHEN NOT ({column} LIKE '*%' OR {column} = '' OR {column} = 'Missing') THEN {column} END AS {column}"


shared("groups", f"""
    SELECT i.*, f.sepsis, f.septic_shock, p.birthdate, {blank("sex")}, {blank("firstrace")}, {blank("ethnicity")},
           date_diff('day', p.birthdate, i.arrivaldatekeyvalue) / 365.25 AS age, d.years AS durationage,
           date_diff('day', p.birthdate, i.arrivaldatekeyvalue) / 365.25 - d.years AS age_delta,
           coalesce(g.imaging, 0) AS imaging, g.firstprocedurename,
           CASE WHEN include AND g.imaging = 1 THEN 'Suspected Sepsis with Imaging'
                WHEN include THEN 'Suspected Sepsis No Imaging' ELSE 'No Suspected Sepsis' END AS include_imaging,
           year(i.arrivaldatekeyvalue) AS year
    FROM {{incl}} i LEFT JOIN {{dxflags}} f ON i.encounterkey = f.encounterkey
    LEFT JOIN {{pttrim}} p ON i.patientdurablekey = p.patientdurablekey
    LEFT JOIN {{s_img}} g ON i.encounterkey = g.encounterkey
    LEFT JOIN {{dur}} d ON i.patientdurablekey = d.durationkey""")


def groups(w):
    # the recorded age is a key into the duration dimension, here the patient's own key
    ages = w["ed"].select("encounterkey", F.col("patientdurablekey").alias("durationkey")).join(
        w["dur"].withColumnRenamed("years", "durationage"), "durationkey"
    )
    images = inc.first_imaging_flag(lung_images(w), arrival(w))
    return inc.inclusion_groups(inclusion(w), dx_flags(w), patients(w), images, ages)


@query("inclusion_groups", "SELECT * REPLACE (round(age, 6) AS age, round(age_delta, 6) AS age_delta) FROM {groups}")
def _(w):
    return groups(w).withColumn("age", F.round("age", 6)).withColumn("age_delta", F.round("age_delta", 6))


CATEGORICAL = ["sex", "firstrace", "sepsis", "septic_shock"]
CONTINUOUS = ["durationage", "wbc", "temp"]
STRATA = {"table1": "include", "table1_imaging": "include_imaging", "table1_year": "year"}


def table1_sql(stratum):
    levels = "\nUNION ALL ".join(
        f"SELECT CAST({stratum} AS VARCHAR) AS stratum, '{v}' AS variable, CAST({v} AS VARCHAR) AS level, count(*) AS n "
        f"FROM {{groups}} GROUP BY ALL" for v in CATEGORICAL
    )
    values = "\nUNION ALL ".join(
        f"SELECT CAST({stratum} AS VARCHAR) AS stratum, '{v}' AS variable, CAST({v} AS DOUBLE) AS x FROM {{groups}}"
        for v in CONTINUOUS
    )
    return f"""
        SELECT stratum, variable, level, n,
               CASE WHEN level IS NOT NULL THEN
                 round(100.0 * n / sum(n) FILTER (WHERE level IS NOT NULL) OVER (PARTITION BY stratum, variable), 2) END AS pct,
               NULL::DOUBLE AS mean, NULL::DOUBLE AS sd, NULL::DOUBLE AS q25, NULL::DOUBLE AS median, NULL::DOUBLE AS q75
        FROM ({levels})
        UNION ALL
        SELECT stratum, variable, NULL, count(x), NULL, round(avg(x), 6), round(stddev_samp(x), 6),
               round(quantile_cont(x, 0.25), 6), round(quantile_cont(x, 0.5), 6), round(quantile_cont(x, 0.75), 6)
        FROM ({values}) GROUP BY stratum, variable"""


def register_table1(name, stratum):
    @query(name, table1_sql(stratum))
    def _(w):
        numbers = ["mean", "sd", "q25", "median", "q75"]
        table = inc.table1(groups(w), CATEGORICAL, CONTINUOUS, stratum)
        return table.select(*[F.round(c, 6).alias(c) if c in numbers else F.col(c) for c in table.columns])


for _name, _stratum in STRATA.items():
    register_table1(_name, _stratum)


@query("visits_per_year", """
    SELECT count(*) AS years, min(n) AS min, quantile_cont(CAST(n AS DOUBLE), 0.25) AS q25,
           quantile_cont(CAST(n AS DOUBLE), 0.5) AS median, round(avg(n), 6) AS mean,
           quantile_cont(CAST(n AS DOUBLE), 0.75) AS q75, max(n) AS max
    FROM (SELECT year(arrivaldatekeyvalue) AS year, count(*) AS n FROM {keys} GROUP BY ALL)""")
def _(w):
    return inc.visits_per_year(keys(w)).withColumn("mean", F.round("mean", 6))
