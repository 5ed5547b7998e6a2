"""Queries: windowed criteria and cohort assembly."""

from pyspark.sql import functions as F

from clinspark.operators import cohort as co
from clinspark.operators.extraction import extract_by_key
from clinspark.operators.windows import within_window
from clinspark.plans.extraction import keys
from clinspark.plans.registry import query, shared
from clinspark.sources.tables import union_sites

# the criteria look at the visits of the extracted cohort
shared("visits", "SELECT ed.* FROM {ed} JOIN {keys} ON ed.encounterkey = keys.encounterkey")
shared("cbc", """
    SELECT encounterkey, min(resultinstant) AS first_cbc_time,
           first(v ORDER BY resultinstant, v) FILTER (WHERE v IS NOT NULL) AS first_wbc_value
    FROM (SELECT l.encounterkey, resultinstant, try_cast(value AS DOUBLE) AS v
          FROM {lab} l JOIN {visits} e ON l.encounterkey = e.encounterkey
          WHERE labcomponentkey IN (994, 2810)
            AND resultinstant BETWEEN arrivalinstant AND arrivalinstant + INTERVAL 2 HOUR)
    GROUP BY encounterkey""")
shared("abtemp", """
    SELECT DISTINCT f.encounterkey, true AS has_abnormal_temp
    FROM {fs} f JOIN {visits} e ON f.encounterkey = e.encounterkey
    WHERE flowsheetrowkey IN (34432, 29366)
      AND takeninstant BETWEEN arrivalinstant AND arrivalinstant + INTERVAL 2 HOUR
      AND (try_cast(value AS DOUBLE) < 36 OR try_cast(value AS DOUBLE) > 38.5)""")
shared("abnormal", """
    SELECT coalesce(t.encounterkey, b.encounterkey) AS encounterkey,
           coalesce(has_abnormal_temp, false) AS has_abnormal_temp,
           coalesce(has_abnormal_wbc, false) AS has_abnormal_wbc, true AS meets_sirs_criteria
    FROM {abtemp} t
    FULL JOIN (SELECT encounterkey, true AS has_abnormal_wbc FROM {cbc}
               WHERE first_wbc_value > 12 OR first_wbc_value < 4) b ON t.encounterkey = b.encounterkey""")
shared("chest", """
    SELECT i.encounterkey, min(orderinginstant) AS first_imaging_time, true AS has_chest_imaging
    FROM {lungall} i JOIN {visits} e ON i.encounterkey = e.encounterkey
    WHERE orderinginstant BETWEEN arrivalinstant AND arrivalinstant + INTERVAL 4 HOUR
    GROUP BY i.encounterkey""")
shared("lungall", "SELECT * FROM {img} WHERE firstprocedurename ILIKE '%chest%' OR firstprocedurename ILIKE '%lung%'")
shared("hypo", """
    SELECT encounterkey, min(takeninstant) AS first_hypotension_time, min(sbp) AS min_sbp, true AS has_hypotension
    FROM (SELECT f.encounterkey, takeninstant, try_cast(split_part(value, '/', 1) AS DOUBLE) AS sbp
          FROM {fs} f JOIN {visits} e ON f.encounterkey = e.encounterkey
          WHERE flowsheetrowkey IN (32710, 27705)
            AND takeninstant BETWEEN arrivalinstant AND arrivalinstant + INTERVAL 4 HOUR)
    WHERE sbp < 90 GROUP BY encounterkey""")
shared("cohort", """
    SELECT cbc.encounterkey, first_cbc_time, first_wbc_value, has_abnormal_temp, has_abnormal_wbc,
           meets_sirs_criteria, coalesce(has_chest_imaging, false) AS has_chest_imaging, first_imaging_time,
           coalesce(has_hypotension, false) AS has_hypotension, first_hypotension_time, min_sbp,
           first_cbc_time AS time_zero, arrivalinstant AS ed_arrival_time
    FROM {cbc} JOIN {abnormal} USING (encounterkey) LEFT JOIN {chest} USING (encounterkey)
    LEFT JOIN {hypo} USING (encounterkey) LEFT JOIN (SELECT encounterkey, arrivalinstant FROM {visits}) USING (encounterkey)""")


def visits(w):
    return extract_by_key(w["ed"], keys(w))


def arrival(w):
    return co.ed_arrival(visits(w))


def lung_images(w):
    return w["img"].where(
        F.lower("firstprocedurename").contains("chest") | F.lower("firstprocedurename").contains("lung")
    )


def cohort(w):
    return co.filtered_cohort(visits(w), w["lab"], w["fs"], lung_images(w))


def criteria(w):
    return co.encounter_criteria(w["lab"], w["fs"], lung_images(w), arrival(w))


@query("ed_arrival", "SELECT DISTINCT encounterkey, arrivalinstant AS ed_arrival_time FROM {visits}")
def _(w):
    return arrival(w)


@query("within_window", """
    SELECT f.*, arrivalinstant AS ed_arrival_time FROM {fs} f JOIN {visits} e ON f.encounterkey = e.encounterkey
    WHERE takeninstant BETWEEN arrivalinstant AND arrivalinstant + INTERVAL 2 HOUR""")
def _(w):
    return within_window(w["fs"], arrival(w), "takeninstant", "ed_arrival_time", 0, 2)


@query("first_cbc_in_window", "SELECT * FROM {cbc}")
def _(w):
    return co.first_cbc_in_window(w["lab"], arrival(w))


@query("abnormal_temp", "SELECT * FROM {abtemp}")
def _(w):
    return co.abnormal_temp(w["fs"], arrival(w))


@query("abnormal_temp_or_wbc", "SELECT * FROM {abnormal}")
def _(w):
    return co.abnormal_temp_or_wbc(
        co.abnormal_temp(w["fs"], arrival(w)), co.first_cbc_in_window(w["lab"], arrival(w))
    )


@query("chest_imaging_in_window", "SELECT * FROM {chest}")
def _(w):
    return co.chest_imaging(lung_images(w), arrival(w))


@query("hypotension_in_window", "SELECT * FROM {hypo}")
def _(w):
    return co.hypotension(w["fs"], arrival(w))


@query("filtered_cohort", "SELECT * FROM {cohort}")
def _(w):
    return cohort(w)


@query("cohort_hypotensive", "SELECT * FROM {cohort} WHERE has_hypotension")
def _(w):
    return co.hypotensive(cohort(w))


@query("cohort_attrition", """
    SELECT step, n, round(100.0 * n / (SELECT count(*) FROM {keys}), 1) AS pct FROM (
      SELECT '0 extracted' AS step, (SELECT count(*) FROM {keys}) AS n
      UNION ALL SELECT '1 arrival time', (SELECT count(*) FROM (SELECT DISTINCT encounterkey, arrivalinstant FROM {visits}))
      UNION ALL SELECT '2 blood count in window', (SELECT count(*) FROM {cbc})
      UNION ALL SELECT '3 abnormal temperature', (SELECT count(*) FROM {abnormal} WHERE has_abnormal_temp)
      UNION ALL SELECT '4 abnormal blood count', (SELECT count(*) FROM {abnormal} WHERE has_abnormal_wbc)
      UNION ALL SELECT '5 either abnormal', (SELECT count(*) FROM {abnormal})
      UNION ALL SELECT '6 cohort', (SELECT count(*) FROM {cohort})
      UNION ALL SELECT '7 cohort with chest imaging', (SELECT count(*) FROM {cohort} WHERE has_chest_imaging)
      UNION ALL SELECT '8 cohort with hypotension', (SELECT count(*) FROM {cohort} WHERE has_hypotension))""")
def _(w):
    return co.attrition(visits(w), keys(w), criteria(w))


SOURCED = """
    SELECT CASE WHEN encounterkey % 2 = 0 THEN 'site_a' ELSE 'site_b' END AS source, * FROM {cohort}"""


def sourced_cohort(w):
    whole = cohort(w)
    return union_sites(
        {"site_a": whole.where("encounterkey % 2 = 0"), "site_b": whole.where("encounterkey % 2 <> 0")}
    )


@query("cohort_by_source", f"""
    SELECT source, count(*) AS n, count(*) FILTER (WHERE has_chest_imaging) AS n_imaging,
           count(*) FILTER (WHERE has_hypotension) AS n_hypotensive
    FROM ({SOURCED}) GROUP BY source""")
def _(w):
    return co.cohort_by_source(sourced_cohort(w))


@query("site_union_counts", """
    SELECT source, count(*) AS n, count(DISTINCT encounterkey) AS n_encounters,
           count(diagnosisname) AS n_named
    FROM (SELECT 'site_a' AS source, encounterkey, diagnosisname FROM {dx}
          UNION ALL SELECT 'site_b', encounterkey, NULL FROM {dx_b}) GROUP BY source""")
def _(w):
    both = union_sites({"site_a": w["dx"], "site_b": w["dx_b"]})
    return both.groupBy("source").agg(
        F.count("*").alias("n"),
        F.count_distinct("encounterkey").alias("n_encounters"),
        F.count("diagnosisname").alias("n_named"),
    )
