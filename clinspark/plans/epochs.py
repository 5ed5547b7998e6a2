"""Queries: epochs after inclusion."""

from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.operators import epochs as ep
from clinspark.operators.extraction import meds_by_class
from clinspark.operators.windows import last_before_anchor
from clinspark.plans.extraction import in_list, keys
from clinspark.plans.registry import query, shared
from clinspark.plans.severity import dx_flags, organ_events, window

LABS, VITALS = list(fv.EPOCH_LABS), list(fv.EPOCH_VITALS)


def label_sql(column, labels):
    cases = " ".join(f"WHEN {column} IN {in_list(names)} THEN '{label}'" for label, names in labels.items())
    return f"CASE {cases} END"


EPOCH = "CAST(floor(date_diff('microsecond', inclusion_timestamp, ts) / 1.8e9) + 1 AS INT)"
shared("m_lab", f"""
    SELECT l.encounterkey, ts, {label_sql("componentname", fv.EPOCH_LABS)} AS label, v, inclusion_timestamp,
           {EPOCH} AS epoch
    FROM {{labnum}} l JOIN {{incl_time}} t ON l.encounterkey = t.encounterkey WHERE label IS NOT NULL""")
shared("m_vital", f"""
    SELECT *, {EPOCH} AS epoch FROM (
      SELECT f.encounterkey, ts, {label_sql("item", fv.EPOCH_VITALS)} AS label, inclusion_timestamp,
           CASE WHEN item = 'BP' THEN (try_cast(regexp_extract(value, '^[0-9]+') AS DOUBLE)
                  + 2 * try_cast(regexp_extract(value, '/([0-9]+)', 1) AS DOUBLE)) / 3
                ELSE try_cast(value AS DOUBLE) END AS v
      FROM {{vit}} f JOIN {{incl_time}} t ON f.encounterkey = t.encounterkey WHERE label IS NOT NULL)""")


def epoch_sql(labels):
    return ", ".join(
        f"round(max(v) FILTER (WHERE label = '{label}' AND epoch = {i}), 6) AS epoch_{i}_{label}"
        for label in labels for i in range(1, 25)
    )


def rounded(df, labels):
    names = set(ep.epoch_columns(labels)) | {f"pre_inclusion_{label}" for label in labels}
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


@query("epoch_assign", f"""
    SELECT l.*, inclusion_timestamp, CASE WHEN e BETWEEN 1 AND 24 THEN e END AS epoch
    FROM (SELECT l.*, t.inclusion_timestamp, {EPOCH} AS e FROM {{lab2}} l JOIN {{incl_time}} t
          ON l.encounterkey = t.encounterkey) l""".replace("l.*, inclusion_timestamp, CASE", "* EXCLUDE (e), CASE"))
def _(w):
    return ep.assign_epoch(w["lab2"], window(w))


@query("lab_epochs", f"SELECT encounterkey, {epoch_sql(LABS)} FROM {{m_lab}} GROUP BY encounterkey")
def _(w):
    return rounded(ep.lab_epochs(w["lab2"], window(w)), LABS)


@query("vital_epochs", f"SELECT encounterkey, {epoch_sql(VITALS)} FROM {{m_vital}} GROUP BY encounterkey")
def _(w):
    return rounded(ep.vital_epochs(w["vit"], window(w)), VITALS)


shared("m_abx", f"""
    SELECT a.encounterkey, {EPOCH.replace("ts)", "administrationinstant)")} AS epoch, administrationaction AS action
    FROM (SELECT *, row_number() OVER (PARTITION BY encounterkey ORDER BY administrationinstant, administrationaction) AS rn
          FROM {{abx}} WHERE administrationaction IN {in_list(fv.GIVEN_ACTIONS)}) a
    JOIN {{incl_time}} t ON a.encounterkey = t.encounterkey WHERE rn = 1""")
ABX = ", ".join(f"max(action) FILTER (WHERE epoch = {i}) AS epoch_{i}_abx" for i in range(1, 25))
shared("w_abx", f"SELECT encounterkey, {ABX} FROM {{m_abx}} GROUP BY encounterkey")


@query("mar_epochs", "SELECT * FROM {w_abx}")
def _(w):
    return ep.mar_epochs(meds_by_class(w["mar"], keys(w)), window(w))


shared("m_all", "SELECT * FROM {m_lab} UNION ALL BY NAME SELECT * FROM {m_vital}")
shared("m_last", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY encounterkey, label ORDER BY ts DESC, v DESC NULLS LAST) AS rn
                   FROM {m_all} WHERE ts < inclusion_timestamp) WHERE rn = 1""")


def last_sql(labels):
    return ", ".join(
        f"round(max(v) FILTER (WHERE label = '{x}'), 6) AS pre_inclusion_{x}, "
        f"max(ts) FILTER (WHERE label = '{x}') AS pre_inclusion_{x}_timestamp" for x in labels
    )


@query("last_before_anchor", f"SELECT encounterkey, {last_sql(LABS + VITALS)} FROM {{m_last}} GROUP BY encounterkey")
def _(w):
    measures = ep.labelled_labs(w["lab2"]).unionByName(ep.labelled_vitals(w["vit"]))
    return rounded(ep.last_before_inclusion(measures, window(w), LABS + VITALS), LABS + VITALS)


@query("last_lab_before", """
    SELECT encounterkey, label, ts, v AS measure FROM {m_last} WHERE label IN ('wbc', 'lactate')""")
def _(w):
    labs = ep.labelled_labs(w["lab2"], {k: fv.EPOCH_LABS[k] for k in ("wbc", "lactate")})
    return last_before_anchor(labs, window(w), "ts", "measure", ep.START, ["encounterkey", "label"])


BOUNDS = ", ".join(
    f"t.inclusion_timestamp + INTERVAL {(i - 1) * 30} MINUTE AS epoch_{i}_begin, "
    f"t.inclusion_timestamp + INTERVAL {i * 30} MINUTE AS epoch_{i}_end" for i in range(1, 25)
)
shared("w_all", f"SELECT encounterkey, {epoch_sql(LABS + VITALS)} FROM {{m_all}} GROUP BY encounterkey")
shared("w_last", f"SELECT encounterkey, {last_sql(LABS + VITALS)} FROM {{m_last}} GROUP BY encounterkey")
shared("matrix", f"""
    SELECT t.*, {BOUNDS}, a.* EXCLUDE (encounterkey), l.* EXCLUDE (encounterkey), x.* EXCLUDE (encounterkey),
           s.* EXCLUDE (encounterkey, inclusion_timestamp, begin_timestamp, midpoint_timestamp, end_timestamp),
           f.* EXCLUDE (encounterkey)
    FROM {{incl_time}} t LEFT JOIN {{w_all}} a ON t.encounterkey = a.encounterkey
    LEFT JOIN {{w_last}} l ON t.encounterkey = l.encounterkey LEFT JOIN {{w_abx}} x ON t.encounterkey = x.encounterkey
    LEFT JOIN {{esofa}} s ON t.encounterkey = s.encounterkey LEFT JOIN {{dxflags}} f ON t.encounterkey = f.encounterkey""")


def matrix_inputs(w):
    # events of all encounters, as the window they are joined to holds the cohort's
    given = meds_by_class(w["mar"], None)
    return window(w), w["lab2"], w["vit"], given, *organ_events(w), dx_flags(w)


def matrix(w):
    return ep.epoch_matrix(*matrix_inputs(w))


@query("epoch_matrix", "SELECT * FROM {matrix}")
def _(w):
    return rounded(matrix(w), LABS + VITALS)


@query("missingness", """
    SELECT name AS key, round(1 - n / (SELECT count(*) FROM {matrix}), 9) AS value
    FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {matrix}) ON COLUMNS(*) INTO NAME name VALUE n)""")
def _(w):
    return ep.matrix_missingness(*matrix_inputs(w)).withColumn("value", F.round("value", 9))


@query("measurement_frequency", """
    SELECT f.encounterkey, count(*) / 4 AS frequency FROM {vit} f JOIN {incl_time} t ON f.encounterkey = t.encounterkey
    WHERE item = 'Pulse' AND ts >= inclusion_timestamp AND ts < inclusion_timestamp + INTERVAL 4 HOUR
    GROUP BY f.encounterkey""")
def _(w):
    return ep.measurement_frequency(w["vit"], window(w))


@query("epoch_coverage", """
    SELECT (epoch_1_pulse IS NOT NULL)::INT + (epoch_2_pulse IS NOT NULL)::INT + (epoch_3_pulse IS NOT NULL)::INT
           + (epoch_4_pulse IS NOT NULL)::INT AS covered, count(*) AS n FROM {matrix} GROUP BY covered""")
def _(w):
    return ep.label_coverage(window(w), ep.labelled_vitals(w["vit"]), "pulse")
