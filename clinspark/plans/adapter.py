"""Views that give the driver's star schema the shape of a hospital warehouse.

The same text serves Spark and DuckDB; ``{name}`` stands for a table or an earlier view, and the few
expressions that the two dialects spell differently come in as parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinspark.config import size_shuffles
from clinspark.sources.tables import stored_bytes

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# (number, code, name, chapter, block) of the diagnoses used by the views
DIAGNOSES = [
    (0, "A41.9", "SEPSIS, UNSPECIFIED ORGANISM", "Infectious diseases", "Other bacterial diseases"),
    (1, "R65.21", "SEVERE SEPSIS WITH SEPTIC SHOCK", "Symptoms and signs", "General symptoms"),
    (2, "J18.9", "PNEUMONIA, UNSPECIFIED", "Respiratory diseases", "Influenza and pneumonia"),
    (3, "N39.0", "URINARY TRACT INFECTION", "Genitourinary diseases", "Other urinary diseases"),
    (4, "K65.0", "PERITONITIS", "Digestive diseases", "Diseases of peritoneum"),
    (5, "L03.90", "CELLULITIS", "Skin diseases", "Infections of the skin"),
    (6, "G03.0", "NONPYOGENIC MENINGITIS", "Nervous system diseases", "Inflammatory diseases"),
    (7, "I33.0", "ENDOCARDITIS", "Circulatory diseases", "Other heart disease"),
    (8, "R57.0", "CARDIOGENIC SHOCK", "Symptoms and signs", "General symptoms"),
    (9, "N17.9", "ACUTE KIDNEY FAILURE", "Genitourinary diseases", "Kidney failure"),
    (10, "R50.9", "FEVER, UNSPECIFIED", "Symptoms and signs", "General symptoms"),
    (11, "Z86.19", "HISTORY OF INFECTION", "Health status", "Family and personal history"),
    (12, "I50.9", "HEART FAILURE", "Circulatory diseases", "Other heart disease"),
    (13, "J44.9", "COPD", "Respiratory diseases", "Chronic lower respiratory diseases"),
    (14, "E11.22", "DIABETES WITH CKD", "Endocrine diseases", "Diabetes mellitus"),
    (15, "E11.9", "DIABETES", "Endocrine diseases", "Diabetes mellitus"),
    (16, "N18.4", "CKD STAGE 4", "Genitourinary diseases", "Kidney failure"),
    (17, "I42.6", "ALCOHOLIC CARDIOMYOPATHY", "Circulatory diseases", "Other heart disease"),
    (18, "C78.00", "LUNG METASTASIS", "Neoplasms", "Malignant neoplasms"),
    (19, "K74.60", "CIRRHOSIS", "Digestive diseases", "Diseases of liver"),
    (20, "I10", "HYPERTENSION", "Circulatory diseases", "Hypertensive diseases"),
    (21, "F31.5", "BIPOLAR", "Mental disorders", "Mood disorders"),
    (22, "K57.90", "DIVERTICULOSIS WITHOUT PERFORATION OR ABSCESS", "Digestive diseases", "Other intestine"),
    (23, "M54.5", "LOW BACK PAIN", "Musculoskeletal diseases", "Dorsopathies"),
]

VIEWS = {
    "ed": """
        SELECT o_orderkey AS encounterkey, o_custkey AS patientdurablekey,
               o_custkey * 10 + CASE WHEN o_custkey % 10 = 0 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS patientkey,
               o_orderkey * 3 AS hospitaladmissionkey,
               CAST(o_orderdate AS DATE) AS arrivaldatekeyvalue,
               lpad(CAST(CAST(floor((o_orderkey % 1440) / 60) AS INT) AS STRING), 2, '0') || ':' ||
                 lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') AS arrivaltimeofdaykeyvalue,
               [ADD_MIN o_orderdate, o_orderkey % 1440] AS arrivalinstant,
               CASE WHEN o_orderkey % 9 <> 0 THEN [ADD_MIN o_orderdate, o_orderkey % 1440 + 200] END AS departureinstant,
               CASE o_orderstatus WHEN 'F' THEN 'Admit' WHEN 'O' THEN 'Discharge' END AS dischargedisposition
        FROM {orders}""",
    "pt": """
        SELECT durablekey, durablekey * 10 + 1 - iscurrent AS patientkey, iscurrent,
               [ADD_DAYS_ (durablekey * 37) % 34000] AS birthdate,
               CASE WHEN durablekey % 2 = 0 THEN 'Female' ELSE 'Male' END AS sex,
               CASE WHEN durablekey % 13 = 0 THEN 'Unknown/Declined' WHEN durablekey % 17 = 0 THEN ''
                    ELSE c_mktsegment END AS firstrace,
               CASE WHEN durablekey % 11 = 0 THEN '*Unspecified' WHEN durablekey % 7 = 0 THEN 'Missing'
                    WHEN durablekey % 19 = 0 THEN 'decline to state' ELSE n_name END AS ethnicity
        FROM (SELECT c_custkey AS durablekey, 1 AS iscurrent, c_mktsegment, c_nationkey FROM {customer}
              UNION ALL
              SELECT c_custkey, 0, c_mktsegment, c_nationkey FROM {customer} WHERE c_custkey % 10 = 0) p
        JOIN {nation} ON c_nationkey = n_nationkey""",
    "loc": "SELECT l_orderkey AS encounterkey, l_suppkey % 5 AS departmentkey FROM {lineitem}",
    "dept": """
        SELECT n_nationkey AS departmentkey,
               CASE WHEN n_nationkey IN (0, 1) THEN 'ED' ELSE n_name END AS departmentname
        FROM {nation}""",
    "dur": "SELECT p_partkey AS durationkey, p_size * 5 - 120 AS years FROM {part}",
    "enc": """
        SELECT o_orderkey AS encounterkey, o_custkey AS primarydiagnosiskey,
               CASE CAST(o_orderkey % 12 AS INT)
                    WHEN 0 THEN '9 ICU' WHEN 1 THEN '10ICC CARDIAC' WHEN 2 THEN 'HOSP MEDICINE SVC'
                    WHEN 3 THEN 'Critical Care Medicine Svc' WHEN 4 THEN 'ED' WHEN 5 THEN NULL
                    WHEN 6 THEN 'BURN UNIT' ELSE o_orderpriority END AS departmentname,
               CASE WHEN o_orderkey % 8 <> 0 THEN o_orderpriority END AS departmentspecialty
        FROM {orders}""",
    "adm": """
        SELECT o_orderkey AS encounterkey, o_orderkey * 3 AS hospitaladmissionkey,
               o_custkey % 30 AS primarycoveragekey,
               CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_totalprice / 20000 AS DOUBLE) END AS lengthofstayindays
        FROM {orders} WHERE o_orderstatus = 'F'""",
    "cov": """
        SELECT n_nationkey AS coveragekey, r_name AS payorfinancialclass, n_name AS payorname
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "icu": """
        SELECT o_orderkey AS encounterkey, CAST(o_totalprice / 50000 AS DOUBLE) AS iculengthofstay
        FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "death": """
        SELECT c_custkey AS patientdurablekey,
               CASE WHEN c_custkey % 7 = 0 THEN [ADD_DAYS_ 30000 + c_custkey % 3000] END AS deathdate
        FROM {customer}""",
    "sdoh": """
        SELECT CASE WHEN event_id % 11 <> 0 THEN event_id END AS socialdeterminantkey,
               event_id AS encounterkey, event_type AS socialdeterminantdomain
        FROM {events}""",
    "sdoh_answer": """
        SELECT event_id AS socialdeterminantkey, props AS answertext FROM {events}
        UNION ALL
        SELECT event_id * 2, event_type FROM {events}""",
    "sdoh_domain": "SELECT user_id AS patientdurablekey, event_type AS socialdeterminantdomain FROM {events}",
    "fs": """
        SELECT e.encounterkey, CASE WHEN l_linenumber % 2 = 0 THEN 34432 ELSE 32710 END AS flowsheetrowkey,
               [ADD_MIN e.arrivalinstant, (l_partkey * 7) % 330 - 30] AS takeninstant,
               CASE WHEN l_linenumber % 2 = 0
                    THEN CAST(CAST(CAST(350 + l_partkey % 45 AS DECIMAL(10, 1)) / 10 AS DECIMAL(10, 1)) AS STRING)
                    WHEN l_partkey % 3 = 0 THEN CAST(70 + l_suppkey % 90 AS STRING)
                    ELSE CAST(70 + l_suppkey % 90 AS STRING) || '/60' END AS value
        FROM {lineitem} JOIN {ed} e ON l_orderkey = e.encounterkey""",
    "lab": """
        SELECT e.encounterkey, CASE WHEN l_linenumber <= 3 THEN 994 ELSE 586 END AS labcomponentkey,
               [ADD_MIN e.arrivalinstant, (l_suppkey * 11) % 200 - 20] AS resultinstant,
               CASE WHEN l_quantity = 13 THEN NULL ELSE CAST(l_quantity / 2 AS STRING) END AS value
        FROM {lineitem} JOIN {ed} e ON l_orderkey = e.encounterkey""",
    "icd": "SELECT * FROM (VALUES [DIAGNOSES]) AS t(i, code, name, chapter, block)",
    "term": """
        SELECT diagnosiskey, type, code AS value, name AS diagnosisname, code || ' ' || name AS displaystring,
               chapter AS l1_name, block AS l2_name, substr(code, 1, 3) || ' ' || block AS l3_name,
               name AS l4_name,
               CASE WHEN i = 0 THEN 'Sepsis without septic shock' WHEN i IN (1, 14) THEN lower(name) END AS l5_name,
               CASE WHEN i = 1 THEN 'Severe sepsis with septic shock' END AS l6_name,
               CASE WHEN i = 8 THEN 'Shock without sepsis' WHEN i = 7 THEN 'Septic embolic shock' END AS l7_name,
               CAST(NULL AS STRING) AS l8_name, CAST(NULL AS STRING) AS l9_name
        FROM (SELECT p_partkey AS diagnosiskey, CASE WHEN p_size % 10 = 0 THEN 'SNOMED' ELSE 'ICD-10-CM' END AS type,
                     p_partkey % 24 AS k FROM {part}
              UNION ALL
              SELECT p_partkey, 'ICD-10-CM', (p_partkey + 7) % 24 FROM {part} WHERE p_partkey % 50 = 0) p
        JOIN {icd} ON k = i""",
    "dx": """
        SELECT l_orderkey AS encounterkey, l_partkey AS diagnosiskey, o_custkey AS patientdurablekey,
               CASE WHEN l_linenumber = 2 THEN name || ', INITIAL' WHEN l_linenumber = 5 THEN NULL
                    ELSE name END AS diagnosisname,
               CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'R' THEN 'No' END AS presentonadmission,
               CASE WHEN l_linenumber = 1 THEN 'Problem List' ELSE 'Encounter Diagnosis' END AS type,
               CAST(l_shipdate AS DATE) AS startdatekeyvalue
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {icd} ON l_partkey % 24 = i""",
    # the second site: other encounters, and diagnosis keys that clash with those of the first
    "dx_b": """
        SELECT -l_orderkey - 1 AS encounterkey, l_partkey AS diagnosiskey,
               CASE WHEN l_linestatus = 'O' THEN 'YES' END AS presentonadmission,
               CASE WHEN l_linenumber = 2 THEN 'Medical History' ELSE 'Encounter Diagnosis' END AS type
        FROM {lineitem}""",
    "term_b": """
        SELECT p_partkey AS diagnosiskey, CASE WHEN p_partkey % 3 <> 0 THEN 'ICD-10-CM' ELSE 'SNOMED' END AS type,
               lower(code) || ' ' AS value
        FROM {part} JOIN {icd} ON (p_partkey + 5) % 24 = i""",
    "codes": """
        SELECT p_partkey AS medicationkey,
               CASE CAST(p_partkey % 12 AS INT)
                    WHEN 0 THEN 'norepinephrine bitartrate 4 mg' WHEN 1 THEN 'Vasopressin 20 units'
                    WHEN 2 THEN 'EPINEPHrine 1 mg' WHEN 3 THEN 'DOBUTamine' WHEN 4 THEN 'phenylephrine HCl'
                    ELSE p_name END AS medicationname,
               CASE p_size % 4 WHEN 0 THEN 'Intravenous' WHEN 1 THEN 'injection' WHEN 2 THEN 'Oral' END AS medicationroute
        FROM {part}""",
    "mar": """
        SELECT e.encounterkey, l_partkey AS medicationkey, p_name AS medicationname,
               CASE WHEN p_type = 'PROMO' THEN 'ANTIBIOTICS' ELSE p_type END AS medicationtherapeuticclass,
               CASE p_size % 3 WHEN 0 THEN 'Intravenous' WHEN 1 THEN 'injection' ELSE 'Oral' END AS medicationroute,
               CASE l_linenumber WHEN 1 THEN 'Given' WHEN 2 THEN 'New Bag' WHEN 3 THEN 'Held'
                    ELSE 'Given by Other' END AS administrationaction,
               [ADD_MIN e.arrivalinstant, (l_partkey * 13) % 900 - 60] AS administrationinstant
        FROM {lineitem} JOIN {ed} e ON l_orderkey = e.encounterkey JOIN {part} ON p_partkey = l_partkey""",
    "img": """
        SELECT e.encounterkey,
               CASE WHEN l_linenumber < 6 THEN 'US ABDOMEN' WHEN l_suppkey % 4 = 0 THEN 'XR Chest 1 View'
                    WHEN l_suppkey % 4 = 1 THEN 'CT LUNG SCREEN' WHEN l_suppkey % 4 = 2 THEN 'CT HEAD'
                    ELSE 'MR SPINE' END AS firstprocedurename,
               CASE WHEN l_linenumber < 6 THEN 'IMG US PROCEDURES' WHEN l_suppkey % 4 = 0 THEN 'IMG XR PROCEDURES'
                    WHEN l_suppkey % 4 = 3 THEN 'OTHER' ELSE 'IMG CT ORDERABLES' END AS firstprocedurecategory,
               [ADD_MIN e.arrivalinstant, (l_partkey * 5) % 400 - 20] AS orderinginstant
        FROM {lineitem} JOIN {ed} e ON l_orderkey = e.encounterkey""",
    # (slot, item, lowest value, step, span)
    "vital_items": """
        SELECT * FROM (VALUES (0, 'Pulse', 35, 11, 110), (1, 'Resp', 6, 7, 25), (2, 'SpO2', 82, 5, 19),
          (3, 'Temp', 94, 1, 10), (4, 'BP', 0, 0, 1), (5, 'FiO2 (%)', 21, 3, 60), (6, 'Best Eye Response', 1, 1, 4),
          (7, 'Best Verbal Response', 1, 1, 5), (8, 'Best Motor Response (upper extremities)', 1, 1, 6),
          (9, 'Temp', 33, 1, 8)) AS t(slot, item, low, step, span)""",
    "vit": """
        SELECT encounterkey, item, ts, CASE WHEN item = 'BP' THEN bp ELSE CAST(num AS STRING) END AS value,
               CASE WHEN item <> 'BP' THEN CAST(num AS DOUBLE) END AS numericvalue, accepted
        FROM (SELECT e.encounterkey, [ADD_MIN e.arrivalinstant, (l_partkey * 17) % 4000 - 60] AS ts,
                CASE WHEN l_quantity = 7 THEN 0 ELSE 1 END AS accepted, item,
                CAST(70 + (l_partkey * 13) % 160 AS STRING) || '/' || CAST(40 + (l_partkey * 3) % 60 AS STRING) AS bp,
                low + (l_partkey * step) % span AS num
              FROM {lineitem} JOIN {ed} e ON l_orderkey = e.encounterkey
              JOIN {vital_items} ON slot = CASE WHEN (l_partkey + l_linenumber) % 9 = 3 AND l_quantity < 25 THEN 9
                                                ELSE (l_partkey + l_linenumber) % 9 END) x""",
    "resp": """
        SELECT e.encounterkey, [ADD_MIN e.arrivalinstant, (l_suppkey * 37) % 6000] AS ts,
               CASE WHEN l_linenumber < 7 THEN 'R SPARE ROW' WHEN l_suppkey % 5 = 0 THEN 'R RESP PEEP/CPAP SET'
                    WHEN l_suppkey % 5 = 1 THEN 'R RT VENT MODE' WHEN l_suppkey % 5 = 2 THEN 'R FIO2'
                    WHEN l_suppkey % 5 = 3 THEN 'R OXYGEN THERAPY' ELSE 'R RT MODE/BREATH TYPE' END AS flowsheetrowname
        FROM {lineitem} JOIN {ed} e ON l_orderkey = e.encounterkey""",
    "lab_items": """
        SELECT * FROM (VALUES (0, 'WBC Count'), (1, 'Creatinine'), (2, 'Lactate, plasma'), (3, 'Bilirubin, Total'),
          (4, 'Platelet Count'), (5, 'Hemoglobin')) AS t(slot, componentname)""",
    "lab2": """
        SELECT e.encounterkey, [ADD_MIN e.arrivalinstant, (l_partkey * 19) % 4000 - 60] AS ts, componentname,
               CASE WHEN l_quantity = 13 THEN 'PENDING'
                    WHEN slot = 4 THEN CAST(CAST(l_quantity * 4 AS INT) AS STRING)
                    ELSE CAST(CAST(CAST(l_quantity AS DECIMAL(10, 2)) / 4 AS DECIMAL(10, 2)) AS STRING) END AS value
        FROM {lineitem} JOIN {ed} e ON l_orderkey = e.encounterkey
        JOIN {lab_items} ON slot = (l_partkey + 2 * l_linenumber) % 6""",
    "person": """
        SELECT c_custkey AS patientdurablekey, [ADD_DAYS_ (c_custkey * 37) % 34000] AS birthdate,
               CASE WHEN c_custkey % 2 = 0 THEN '2' ELSE '1' END AS sex,
               CASE WHEN c_custkey % 5 = 0 THEN '1' ELSE '0' END AS orec,
               CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS nemcaid,
               CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS ltimcaid
        FROM {customer}""",
}

_SPARK = {
    "ADD_MIN": lambda ts, n: f"timestampadd(MINUTE, CAST({n} AS INT), {ts})",
    "ADD_DAYS_": lambda n: f"date_add(DATE'1925-01-01', CAST({n} AS INT))",
}
_DUCKDB = {
    "ADD_MIN": lambda ts, n: f"({ts} + to_minutes(CAST({n} AS BIGINT)))",
    "ADD_DAYS_": lambda n: f"(DATE '1925-01-01' + CAST({n} AS INTEGER))",
}


def _render(text: str, dialect: dict) -> str:
    rows = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in DIAGNOSES)
    text = text.replace("[DIAGNOSES]", rows)
    while "[" in text:
        start, end = text.rindex("["), text.index("]", text.rindex("["))
        name, _, arguments = text[start + 1 : end].partition(" ")
        parts = [a.strip() for a in arguments.split(", ", 1)] if name == "ADD_MIN" else [arguments]
        text = text[:start] + dialect[name](*parts) + text[end + 1 :]
    return text


def _uses(text: str) -> list[str]:
    return [n for n in [*BASE_TABLES, *VIEWS] if "{" + n + "}" in text]


class Warehouse:
    """The driver's tables under ``sf_dir`` and the views over them, as DataFrames by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._bytes = 0

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in BASE_TABLES:
                path = f"{self.sf_dir}/{name}.parquet"
                frame = self.spark.read.parquet(path)
                self._bytes += stored_bytes(self.spark, path)
                size_shuffles(self.spark, self._bytes)
            else:
                text = _render(VIEWS[name], _SPARK)
                frame = self.spark.sql(text, **{n: self[n] for n in _uses(text)})
            self._frames[name] = frame
        return self._frames[name]

