"""Operator rules that are easy to get wrong, on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.operators import cohort as co
from clinspark.operators import comorbidity as cm
from clinspark.operators import covariates as cv
from clinspark.operators import diagnosis as dg
from clinspark.operators import epochs as ep
from clinspark.operators import esofa as es
from clinspark.operators import extraction as x
from clinspark.operators import hcc as hc
from clinspark.operators import inclusion as inc
from clinspark.operators import severity as sv
from clinspark.operators import summary as sm
from clinspark.operators.windows import first_n_per_group, first_row, within_window

T0 = dt.datetime(2024, 1, 1, 8, 0)


def at(hours=0, minutes=0):
    return T0 + dt.timedelta(hours=hours, minutes=minutes)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_first_row_does_not_depend_on_input_order(rows):
    data = [(1, T0, 5.0), (1, T0, 3.0), (1, at(1), 1.0), (2, None, 1.0), (2, T0, None)]
    for order in (data, data[::-1]):
        df = rows("k int, ts timestamp_ntz, v double", *order)
        assert rows_of(first_row(df, ["k"], ["ts"], ["v"])) == [(1, T0, 3.0), (2, T0, None)]


def test_first_n(rows):
    df = rows("k int, ts int", *[(1, i) for i in range(9)], (2, 1))
    assert rows_of(first_n_per_group(df, ["k"], ["ts"], 5)) == [(1, i, i + 1) for i in range(5)] + [(2, 1, 1)]


def test_window_ends(rows):
    events = rows("encounterkey int, ts timestamp_ntz", *[(1, at(h)) for h in (-1, 0, 1, 2, 3)], (1, None))
    anchor = rows("encounterkey int, a timestamp_ntz", (1, T0))
    for closed, hours in (("both", [0, 1, 2]), ("left", [0, 1]), ("none", [1])):
        got = within_window(events, anchor, "ts", "a", 0, 2, closed=closed)
        assert rows_of(got, "ts") == [(at(h),) for h in hours]


def visits(rows, *data):
    return rows("encounterkey int, arrivalinstant timestamp_ntz", *data)


def test_first_count_value_may_be_of_a_later_sample(rows):
    labs = rows(
        "encounterkey int, labcomponentkey int, resultinstant timestamp_ntz, value string",
        (1, 994, at(0, 10), "pending"), (1, 994, at(1), "13.5"), (1, 994, at(0, 90), "3"), (1, 586, T0, "1"),
        (2, 994, at(-1), "20"), (3, 2810, at(2), "5"),
    )
    arrival = co.ed_arrival(visits(rows, (1, T0), (2, T0), (3, T0)))
    assert rows_of(co.first_cbc_in_window(labs, arrival)) == [(1, at(0, 10), 13.5), (3, at(2), 5.0)]


def criteria_inputs(rows):
    labs = rows(
        "encounterkey int, labcomponentkey int, resultinstant timestamp_ntz, value string",
        (1, 994, at(1), "13"), (2, 994, at(1), "8"), (3, 994, at(1), "8"), (4, 994, at(5), "20"),
    )
    flow = rows(
        "encounterkey int, flowsheetrowkey int, takeninstant timestamp_ntz, value string",
        (2, 34432, at(1), "39"), (3, 34432, at(3), "39"), (1, 32710, at(3), "85/50"), (1, 32710, at(2), "88"),
        (2, 32710, at(5), "60/30"), (3, 34432, at(1), "38.5"),
    )
    images = rows("encounterkey int, orderinginstant timestamp_ntz", (1, at(4)), (2, at(4, 1)))
    return labs, flow, images


def test_filtered_cohort(rows):
    labs, flow, images = criteria_inputs(rows)
    ed = visits(rows, (1, T0), (2, T0), (3, T0), (4, T0))
    got = {r["encounterkey"]: r for r in co.filtered_cohort(ed, labs, flow, images).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["has_abnormal_wbc"], got[1]["has_abnormal_temp"], got[1]["min_sbp"]) == (True, False, 85.0)
    assert got[1]["first_hypotension_time"] == at(2) and got[1]["first_imaging_time"] == at(4)
    assert (got[2]["has_abnormal_temp"], got[2]["has_hypotension"], got[2]["has_chest_imaging"]) == (True, False, False)


def test_one_pass_criteria_equal_the_separate_ones(rows):
    labs, flow, images = criteria_inputs(rows)
    arrival = co.ed_arrival(visits(rows, (1, T0), (2, T0), (3, T0), (4, T0)))
    whole = co.encounter_criteria(labs, flow, images, arrival)
    either = co.abnormal_temp_or_wbc(co.abnormal_temp(flow, arrival), co.first_cbc_in_window(labs, arrival))
    flags = ["encounterkey", "has_abnormal_temp", "has_abnormal_wbc", "meets_sirs_criteria"]
    assert rows_of(whole.where("meets_sirs_criteria"), *flags) == rows_of(either, *flags)
    assert rows_of(whole.where("has_hypotension"), "encounterkey", "min_sbp") == rows_of(
        co.hypotension(flow, arrival), "encounterkey", "min_sbp"
    )


def test_two_arrivals_of_an_encounter_give_two_rows(rows):
    labs, flow, images = criteria_inputs(rows)
    ed = visits(rows, (1, T0), (1, at(0, 30)), (1, T0))
    assert rows_of(co.filtered_cohort(ed, labs, flow, images), "encounterkey", "ed_arrival_time") == [
        (1, T0), (1, at(0, 30)),
    ]


def test_raw_temperatures_are_compared_as_recorded(rows):
    flow = rows("encounterkey int, flowsheetrowkey int, takeninstant timestamp_ntz, value string", (1, 34432, T0, "98.6"))
    arrival = co.ed_arrival(visits(rows, (1, T0)))
    assert co.abnormal_temp(flow, arrival).count() == 1
    assert co.abnormal_temp(flow, arrival, unit_policy="normalise").count() == 0


def test_encounter_keys_keep_current_adults_of_the_department(rows):
    ed = rows(
        "encounterkey int, patientkey int, patientdurablekey int, arrivaldatekeyvalue date, hospitaladmissionkey int",
        (1, 10, 1, dt.date(2018, 1, 1), 5), (2, 20, 2, dt.date(2018, 1, 1), 6), (3, 30, 3, dt.date(2018, 1, 1), 7),
    )
    patients = rows(
        "durablekey int, iscurrent int, birthdate date",
        (1, 1, dt.date(2000, 12, 31)), (1, 0, dt.date(2010, 1, 1)), (2, 1, dt.date(2001, 1, 1)), (3, 1, dt.date(1950, 1, 1)),
    )
    places = rows("encounterkey int, departmentkey int", (1, 7), (1, 7), (1, 8), (2, 7), (3, 8))
    departments = rows("departmentkey int, departmentname string", (7, "ED"), (8, "Ward"))
    assert rows_of(x.encounter_keys(ed, patients, places, departments, "ED"), "encounterkey") == [(1,)]


def test_death_rows_fan_out_or_not(rows):
    keys = rows("encounterkey int, patientdurablekey int", (1, 1), (2, 1), (3, 2))
    registry = rows("patientdurablekey int, deathdate string", (1, "x"), (9, "y"))
    assert x.death_rows(registry, keys).count() == 2
    assert x.death_rows(registry, keys, "semi").count() == 1


def test_vasopressors_without_route_column(rows):
    codes = rows("medicationkey int, medicationname string", (1, "norEPINEPHrine"), (2, "water"))
    mar = rows("encounterkey int, medicationkey int", (1, 1), (1, 2), (2, 1))
    keys = rows("encounterkey int", (1,))
    assert rows_of(x.meds_by_name(codes, mar, keys)) == [(1, 1)]
    routed = codes.withColumn("MedicationRoute", F.lit("Oral"))
    assert x.meds_by_name(routed, mar, keys).count() == 0


FLOW = "encounterkey int, item string, ts timestamp_ntz, value string, numericvalue double, accepted int"


def test_news_parts(rows):
    flow = rows(
        FLOW,
        (1, "Resp", T0, "22", 22.0, 1), (1, "Resp", at(-1), "5", 5.0, 0), (1, "SpO2", T0, "93", 93.0, 1),
        (1, "FiO2 (%) - O2 Device #2", at(1), "40", 40.0, 1), (1, "FiO2 (%)", at(-1), "21", 21.0, 1),
        (1, "Temp", T0, "102.5", 102.5, 1), (1, "BP", T0, "100/60", None, 1), (1, "Pulse", T0, "131", 131.0, 1),
        (1, "Best Eye Response", T0, "4", 4.0, 1), (1, "Best Verbal Response", T0, "4", 4.0, 1),
        (2, "BP", T0, "refused", None, 1), (2, "BP", at(1), "80/40", None, 1),
    )
    got = {r["encounterkey"]: r.asDict() for r in sv.news_total(flow).collect()}
    assert got[1] == {
        "encounterkey": 1, "news_resp": 2, "news_spo2": 2, "news_suppox": 2, "news_temp": 2, "news_bp": 2,
        "news_pulse": 3, "news_consciousness": 3, "news_2_score": 16,
    }
    assert got[2]["news_bp"] is None and got[2]["news_suppox"] is None and got[2]["news_2_score"] == 0
    assert rows_of(sv.news_spo2_scale2(flow)) == [(1, 93.0, 1)]


def test_sirs_flags_add_up_over_missing_ones(rows):
    flow = rows(FLOW, (1, "Temp", T0, "35", 35.0, 1), (1, "Pulse", T0, "91", 91.0, 1), (1, "Resp", T0, "20", 20.0, 1))
    labs = rows("encounterkey int, componentname string, ts timestamp_ntz, value string", (2, "WBC Count", T0, "<0.1"), (2, "WBC Count", at(1), "3.9"))
    assert rows_of(sv.sirs_score(flow, labs), "encounterkey", "sirs_score") == [(1, 2), (2, 1)]


def test_inclusion_time_is_that_of_the_flag(rows):
    data = rows(
        "encounterkey int, wbc_time timestamp_ntz, sirs_wbc int, temp_time timestamp_ntz, sirs_temp int, include boolean",
        (1, at(2), 1, at(1), 0, True), (2, at(2), 1, at(1), 1, True), (3, None, None, at(3), 1, True), (4, T0, 0, T0, 0, False),
    )
    got = inc.inclusion_timestamp(data)
    assert rows_of(got, "encounterkey", "inclusion_timestamp") == [(1, at(2)), (2, at(1)), (3, at(3))]
    assert rows_of(got.where("encounterkey = 1"), "begin_timestamp", "end_timestamp") == [(at(46), at(54))]


def test_a_code_counts_wherever_its_name_was_found(rows):
    levels = ", ".join(f"l{i}_name string" for i in range(1, 10))
    blank = [None] * 9
    named = blank.copy()
    named[5] = "Severe SEPSIS with shock"
    without = blank.copy()
    without[4] = "Sepsis without septic shock"
    terms = rows(
        f"diagnosiskey int, type string, value string, {levels}",
        (1, "ICD-10-CM", "A", *named), (2, "ICD-10-CM", "A", *blank), (3, "ICD-10-CM", "B", *without),
        (4, "ICD-10-CM", "C", *blank), (5, "SNOMED", "A", *named),
    )
    dx = rows("encounterkey int, diagnosiskey int", (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 1))
    keys = rows("encounterkey int", *[(i,) for i in range(1, 6)])
    assert rows_of(inc.dx_flags(dx, terms, keys)) == [(1, True, True), (2, True, True), (3, True, False), (4, False, False)]


def window_of(rows):
    anchor = rows("encounterkey int, inclusion_timestamp timestamp_ntz", (1, T0), (2, T0))
    return inc.window_around(anchor)


def test_esofa_rules(rows):
    window = window_of(rows)
    labs = rows(
        "encounterkey int, componentname string, ts timestamp_ntz, value string",
        (1, "Creatinine", T0, "1.0"), (1, "Creatinine", at(48), "2.0"), (1, "Lactate, plasma", at(44), "9"),
        (1, "Bilirubin, Total", T0, "0.5"), (1, "Bilirubin, Total", at(48), "1.5"),
        (1, "Platelet Count", T0, "200"), (1, "Platelet Count", at(50), "99"), (1, "Platelet Count", at(47), "150"),
        (2, "Creatinine", T0, "pending"), (2, "Creatinine", at(48), "9"), (2, "Platelet Count", T0, "90"), (2, "Platelet Count", at(48), "40"),
    )
    times = "encounterkey int, ts timestamp_ntz"
    pressors, vent = rows(times, (1, at(47)), (2, at(48))), rows(times, (2, at(1)))
    got = {r["encounterkey"]: r for r in es.esofa(window, pressors, vent, labs).collect()}
    flags = es.PARTS + ["esofa_count", "esofa_binary"]
    assert [got[1][f] for f in flags] == [1, None, None, 1, None, 1, 3, 1]
    assert [got[2][f] for f in flags] == [None, 1, None, None, None, None, 1, 1]


def test_epochs_are_half_open(rows):
    events = rows("encounterkey int, ts timestamp_ntz", *[(1, at(0, m)) for m in (-1, 0, 29, 30, 719, 720)])
    anchor = rows("encounterkey int, inclusion_timestamp timestamp_ntz", (1, T0))
    got = [r["epoch"] for r in ep.assign_epoch(events, anchor).orderBy("ts").collect()]
    assert got == [None, 1, 1, 2, 24, None]


def test_measure_matrix(rows):
    anchor = rows("encounterkey int, inclusion_timestamp timestamp_ntz", (1, T0))
    measures = rows(
        "encounterkey int, ts timestamp_ntz, label string, measure double",
        (1, at(0, 1), "wbc", 5.0), (1, at(0, 2), "wbc", 7.0), (1, at(0, 3), "wbc", None),
        (1, at(-2), "wbc", 1.0), (1, at(-1), "wbc", None), (1, at(-3), "map", 80.0), (1, at(99), "map", 1.0),
    )
    row = ep.measure_matrix(measures, anchor, ["wbc", "map"]).first()
    assert row["epoch_1_wbc"] == 7.0 and row["epoch_2_wbc"] is None and row["epoch_1_map"] is None
    # the last row before inclusion counts even when its value does not parse
    assert row["pre_inclusion_wbc"] is None and row["pre_inclusion_wbc_timestamp"] == at(-1)
    assert row["pre_inclusion_map"] == 80.0 and row["pre_inclusion_map_timestamp"] == at(-3)
    alone = ep.last_before_inclusion(measures, anchor, ["wbc", "map"]).first()
    assert alone["pre_inclusion_wbc_timestamp"] == at(-1) and alone["pre_inclusion_map"] == 80.0


def test_missingness(rows):
    got = ep.missingness(rows("a int, b string", (1, None), (2, "x"), (None, None)))
    assert rows_of(got) == [("a", pytest.approx(1 / 3)), ("b", pytest.approx(2 / 3))]


CODES = "encounterkey int, icd_code string, poa_qualified boolean"


def test_cerebrovascular_parts_keep_their_own_evidence_rule(rows):
    mapping = rows("icd_code string, category string", ("I1", "CBVD_POA"), ("I2", "CBVD_SQLA"), ("E1", "DIAB_CX"), ("E1", "DIAB_UNCX"))
    dx = rows(CODES, (1, "I1", False), (2, "I2", False), (3, "I1", True), (4, "E1", False))
    assert rows_of(cm.ahrq_long(dx, mapping)) == [
        (1, "CBVD", False), (2, "CBVD", True), (3, "CBVD", True), (4, "DIAB_CX", True), (4, "DIAB_UNCX", True),
    ]


def test_prefixes_equal_a_plain_prefix_search(rows):
    codes = ["I426", "I43", "I4390", "F315", "F3150", "E1122", "I1", "", "C7800", "K7460", "Z999"]
    dx = rows(CODES, *[(i, code, False) for i, code in enumerate(codes)], (99, None, True))
    want = sorted(
        {
            (i, category)
            for i, code in enumerate(codes)
            for category, prefixes in fv.QUAN_CODES.items()
            for prefix in prefixes
            if code.startswith(prefix)
        }
    )
    assert rows_of(cm.quan_long(dx), "encounterkey", "category") == want


def test_prefixes_of_other_lengths(rows):
    dx = rows(CODES, (1, "I4261", True), (2, "I42", True))
    table = rows("prefix string, category string, poa_dependent boolean", ("I4261", "deep", False), ("I4", "wide", True))
    got = cm.quan_long(dx, table, lengths=(2, 5))
    assert rows_of(got) == [(1, "deep", True), (1, "wide", True), (2, "wide", True)]
    with pytest.raises(Exception, match="prefix of a length not among"):
        cm.quan_long(dx, table).collect()


def test_categories_without_a_column_are_refused(rows):
    long = rows("encounterkey int, category string, poa boolean", (1, "chf", False), (1, "new", True))
    cohort = rows("encounterkey int", (1,))
    with pytest.raises(Exception, match="category without a column: new"):
        cm.to_wide(long, cohort, ["chf"]).collect()
    with pytest.raises(Exception, match="category without a column"):
        cm.ccsr_features(long, cohort, ["chf"]).collect()


def test_features_count_categories_without_weight(rows):
    mapping = rows("icd_code string, category string", ("A", "HF"), ("B", "NOWEIGHT"))
    dx = rows(CODES, (1, "A", True), (1, "B", False), (2, "I10", False))
    listed = {"ahrq": [*fv.VW_WEIGHTS_AHRQ, "NOWEIGHT"], "quan": list(fv.QUAN_CODES)}
    got = {r["encounterkey"]: r for r in cm.elixhauser_features(dx, rows("encounterkey int", (1,), (2,)), mapping, categories=listed).collect()}
    assert (got[1]["ahrq_all_noweight"], got[1]["ahrq_all_count"], got[1]["ahrq_poa_count"]) == (1, 2, 2)
    assert got[1]["ahrq_all_vw_score"] == fv.VW_WEIGHTS_AHRQ["HF"] and got[2]["quan_all_hypunc"] == 1 and got[2]["quan_poa_hypunc"] == 1


def test_codes_by_literal_expectation(rows):
    """A few codes of every kind, written down by hand from the published table."""
    wanted = {
        "I099": "chf", "I420": "chf", "I4100": None, "I441": "carit", "I444": None, "A520": "valv", "I052": "valv", "I26": "pcd", "I289": "pcd",
        "I710": "pvd", "I10": "hypunc", "I119": "hypc", "I15": "hypc", "G041": "para", "G82": "para", "G20": "ond", "R56": "ond", "J449": "cpd",
        "E119": "diabunc", "E112": "diabc", "E890": "hypothy", "N19": "rf", "B18": "ld", "K257": "pud", "K254": None, "B24": "aids", "C81": "lymph",
        "C77": "metacanc", "C50": "solidtum", "M05": "rheumd", "D65": "coag", "D692": None, "E66": "obes", "E40": "wloss", "E86": "fed",
        "D500": "blane", "D508": "dane", "F10": "alcohol", "F11": "drug", "F17": None, "F20": "psycho", "F32": "depre",
    }
    got = dict(rows_of(cm.quan_long(rows(CODES, *[(i, c, False) for i, c in enumerate(wanted)])), "encounterkey", "category"))
    assert {c: got.get(i) for i, c in enumerate(wanted)} == wanted


def test_grouping_by_diagnosis_key_equals_grouping_by_code(rows):
    dx = rows("encounterkey int, diagnosiskey int, poa_qualified boolean", (1, 1, True), (1, 2, False), (2, 2, True), (3, 9, True))
    codes = rows("diagnosiskey int, icd_code string", (1, "I10"), (1, "E119"), (2, "I509"), (2, "I10"))
    by_code = dx.join(codes, "diagnosiskey").drop("diagnosiskey")
    assert rows_of(cm.quan_long(dx, codes=codes)) == rows_of(cm.quan_long(by_code))
    crosswalk = rows("icd_code string, hcc int", ("I509", 226), ("E119", 38), ("E119", 37))
    assert rows_of(hc.hcc_cc_set(dx, crosswalk, codes=codes)) == rows_of(hc.hcc_cc_set(by_code, crosswalk))
    both = rows_of(hc.hcc_cc_sets(dx, crosswalk, codes=codes))
    assert both == [(1, [37, 38, 226], [37, 38]), (2, [226], [226])]


def test_wide_features_and_scores(rows):
    long = rows("encounterkey int, category string, poa boolean", (1, "chf", False), (1, "depre", True), (2, "drug", True))
    cohort = rows("encounterkey int", (1,), (2,), (3,), (3,))
    wide = cm.to_wide(long, cohort, list(fv.QUAN_CODES), "quan_all_")
    assert rows_of(wide, "encounterkey", "quan_all_chf", "quan_all_depre", "quan_all_drug") == [(1, 1, 1, 0), (2, 0, 0, 1), (3, 0, 0, 0)]
    assert rows_of(cm.weighted_score(long, cohort, fv.VW_WEIGHTS_QUAN)) == [(1, 4, 2), (2, -7, 1), (3, 0, 0)]
    many = [f"c{i}" for i in range(200)]
    spread = cm.to_wide(rows("encounterkey int, category string", (1, "c0"), (1, "c59"), (1, "c60"), (1, "c199")), cohort, many)
    first = spread.where("encounterkey = 1").first()
    assert [c for c in many if first[c]] == ["c0", "c59", "c60", "c199"]


def fold(codes):
    kept = set(codes)
    for parent, children in fv.HCC_HIERARCHY:
        if parent in kept:
            kept -= set(children)
    return sorted(kept)


def test_hierarchy_equals_a_plain_loop(rows):
    chance = random.Random(3)
    sets = [chance.sample(fv.HCC_NUMBERS, chance.randint(0, 25)) for _ in range(150)] + [[62, 63, 202], [223], []]
    df = rows("i int, cc array<int>", *enumerate(sets))
    got = {r["i"]: sorted(r["h"]) for r in df.select("i", hc.apply_hierarchy(F.col("cc")).alias("h")).collect()}
    assert got == {i: fold(s) for i, s in enumerate(sets)}
    assert got[150] == [62, 202]


def test_heart_patch_and_count_terms(rows):
    df = rows("cc array<int>", ([223],), ([223, 221],), ([17],))
    assert [r[0] for r in df.select(hc.heart_patch(F.col("cc"))).collect()] == [[], [223, 221], [17]]
    n = rows("n int", (0,), (1,), (9,), (10,), (14,))
    assert [r[0] for r in n.select(hc.dcount_key(F.col("n"))).collect()] == [None, "D1", "D9", "D10P", "D10P"]


def test_long_form_keeps_what_only_the_poa_variant_has(rows):
    dx = rows(CODES, (1, "A", False), (1, "B", True), (2, "A", True), (3, "B", False), (4, "B", True))
    crosswalk = rows("icd_code string, hcc int", ("A", 17), ("B", 18))
    both = hc.hcc_both(dx, crosswalk, rows("feature string, coef double", ("HCC17", 1.0)))
    long = hc.hcc_long(both)
    want = [(1, "HCC17", True, False), (1, "HCC18", False, True), (2, "HCC17", True, True), (3, "HCC18", True, False), (4, "HCC18", True, True)]
    assert sorted(tuple(r) for r in long.select("encounterkey", "category", "all", "poa").collect()) == want
    other = rows("encounterkey int, category string, poa boolean", (1, "X", True), (2, "X", False))
    got = cm.prevalence_all({"hcc": long, "other": other}, rows("encounterkey int", (1,), (2,), (3,), (4,)))
    assert sorted((r["category"], r["n"], r["n_poa"]) for r in got.collect()) == [("HCC17", 2, 1), ("HCC18", 2, 2), ("X", 2, 1)]
    # the counts are the column sums of the wide form
    wide = hc.hcc_features_wide(both, rows("encounterkey int", (1,), (2,), (3,), (4,)), [17, 18])
    sums = wide.agg(*[F.sum(f"hcc_{v}_hcc{c}") for c in (17, 18) for v in ("all", "poa")]).first()
    assert tuple(sums) == (2, 1, 2, 2)
    drops = cm.poa_impact_all(got).collect()
    assert [(r["category"], r["delta_pct"]) for r in drops if r["system"] == "hcc"] == [("HCC17", 25.0)]


def test_raf_score(rows):
    dx = rows(CODES, (1, "A", True), (1, "B", False), (2, "C", True), (3, "Z", True))
    crosswalk = rows("icd_code string, hcc int", ("A", 37), ("B", 226), ("C", 223))
    table = rows("feature string, coef double", ("HCC37", 0.2), ("HCC226", 0.3), ("DIABETES_HF_V28", 0.1), ("D2", 0.05))
    got = hc.hcc_features(dx, crosswalk, table)
    assert rows_of(got, "encounterkey", "hcc_count", "raf_score") == [(1, 2, 0.65), (2, 0, 0.0)]
    strict = hc.hcc_features(dx, crosswalk, table, poa_only=True)
    assert rows_of(strict, "encounterkey", "raf_score") == [(1, 0.2), (2, 0.0)]
    wide = hc.hcc_wide(got, rows("encounterkey int", (1,), (3,)))
    assert rows_of(wide, "encounterkey", "hcc_all_hcc37", "hcc_all_count") == [(1, 1, 2), (3, 0, 0)]


def test_age_and_sex_edits(rows):
    person = rows("p int, age int, sex string", (1, 17, "2"), (2, 49, "1"), (3, 50, "1"))
    dx = rows("p int, icd_code string, poa_qualified boolean", *[(p, c, True) for p in (1, 2, 3) for c in ("D66", "J42", "C50911", "P041")])
    crosswalk = rows("icd_code string, hcc int", ("D66", 111), ("J42", 280), ("C50911", 23), ("P041", 190))
    want = [(1, [22, 112]), (2, [22, 111, 280]), (3, [23, 111, 280])]
    assert rows_of(hc.edited_cc_set(dx, crosswalk, person, "p")) == want
    # by diagnosis key, with a key that has two codes and one that has none
    terms = rows("diagnosiskey int, icd_code string", (1, "D66"), (2, "J42"), (3, "C50911"), (3, "C50911"), (4, "P041"), (5, "D66"), (5, "J42"))
    facts = rows("p int, diagnosiskey int, poa_qualified boolean", *[(p, d, d != 5) for p in (1, 2, 3) for d in (1, 2, 3, 4, 9)], (4, 5, False), (9, 1, True))
    person = person.unionByName(rows("p int, age int, sex string", (4, 30, "2")))
    assert rows_of(hc.edited_cc_set(facts, crosswalk, person, "p", codes=terms)) == [*want, (4, [112, 280])]
    assert rows_of(hc.edited_cc_set(facts, crosswalk, person, "p", poa_only=True, codes=terms)) == want
    # the class alone gives a category to a code that the crosswalk does not know
    assert rows_of(hc.edited_cc_set(facts, crosswalk.where("icd_code <> 'D66'"), person, "p", codes=terms))[0] == (1, [22, 112])


def test_sites_share_diagnosis_keys(rows):
    dx = rows("source string, encounterkey int, diagnosiskey int, presentonadmission string, type string", ("a", 1, 5, "Yes", "x"))
    terms = rows("source string, diagnosiskey int, type string, value string", ("a", 5, "ICD-10-CM", "I10"), ("b", 5, "ICD-10-CM", "E11.9"))
    cohort = rows("encounterkey int", (1,))
    assert rows_of(cm.dx_code_set(dx, terms, cohort), "icd_code") == [("E119",), ("I10",)]
    assert rows_of(cm.dx_code_set(dx, terms, cohort, site="source"), "icd_code") == [("I10",)]


@pytest.mark.parametrize(
    "code, name, want",
    [
        ("Z86.19", "SEPSIS", None), ("N18.4", "SEPSIS", None), ("A41.9", "", "sepsis_bacteremia"),
        ("X", "aseptic necrosis", None), ("J84.116", "CRYPTOGENIC ORGANIZING PNEUMONIA", None),
        ("J18.9", "", "infection_respiratory"), ("L05.92", "PILONIDAL SINUS WITHOUT ABSCESS", None),
        ("K57.90", "DIVERTICULOSIS WITHOUT PERFORATION OR ABSCESS", None), ("N61.1", "ABSCESS OF BREAST", "infection_skin"),
        ("I70.261", "ATHEROSCLEROSIS WITH GANGRENE", None), ("E11.52", "DIABETES WITH GANGRENE", "infection_skin"),
        ("G03.0", "NONPYOGENIC MENINGITIS", None), ("G03.9", "", "infection_other"), ("T81.1", "POSTPROCEDURAL SHOCK", "shock"),
        ("R41.82", "", "organ_dysfunction"), ("R41.821", "", None), ("F60", "EPISODIC", None), ("X", "DIC", "organ_dysfunction"),
        ("R68.83", "CHILLS WITHOUT FEVER", None), ("R50.9", None, "fever"), (None, None, None),
    ],
)
def test_sepsis_classes(rows, code, name, want):
    df = rows("c string, n string, l string", (code, name, None))
    category = dg.sepsis_category(F.col("c"), F.col("n"), F.col("l"), F.col("l"), F.col("l"))
    assert df.select(category).first()[0] == want


def test_commonest_name_ties_go_to_the_lowest(rows):
    dx = rows(
        "icd_value string, diagnosisname string, icd_type string, icd_l1_name string, icd_l2_name string, icd_l3_name string",
        ("A", "b", None, "x", None, None), ("A", "a", "t", None, None, None), ("A", None, "t", None, None, None), ("B", None, "t", None, None, None),
    )
    assert rows_of(dg.top_icd_codes(dx), "icd_value", "diagnosisname", "count") == [("A", "a", 3), ("B", None, 1)]
    assert dg.top_icd_codes(dx, 1).count() == 1 and dg.top_icd_codes(dx, None).count() == 2


def test_concept_table(rows):
    stats = rows(
        "raw_name string, data_type string, site string, records long, encounters long",
        ("BUN", "Laboratory", "b", 5, 2), ("Urea Nitrogen", "Laboratory", "a", 7, 3), ("Odd", "Respiratory", "a", 1, 1),
    )
    table = cv.covariate_table(stats, ["a", "b"])
    got = rows_of(table, "concept", "a_names", "b_names", "a_records", "total_records", "total_encounters")
    assert got == [("BUN", "Urea Nitrogen", "BUN", 7, 12, 5), ("Odd", "Odd", "", 1, 1, 1)]
    assert rows_of(cv.covariate_top_n(table, 1), "concept", "rank") == [("BUN", 1)]


def test_first_marker_word_wins(rows):
    labs = rows("encounterkey int, componentname string", (1, "WBC Count"), (1, "Leukocyte esterase"), (2, "Lactic acid"), (2, None))
    assert rows_of(sm.marker_search(labs)) == [("WBC", "wbc", 1, 1), ("lactate", "lactic", 1, 1)]


def test_time_to_treatment_over_all_doses_or_the_first(rows):
    mar = rows("encounterkey int, administrationinstant timestamp_ntz", (1, at(1)), (1, at(3)), (2, None))
    ed = visits(rows, (1, T0), (2, T0))
    assert sm.time_to_treatment(mar, ed).first()["median"] == 120.0
    assert sm.time_to_treatment(mar, ed, first_only=True).first()["median"] == 60.0


def test_summary_without_optional_tables(rows):
    keys = rows("encounterkey int, patientdurablekey int", (1, 1), (2, 1))
    row = sm.dataset_summary({"labs": rows("encounterkey int", (1,))}, keys).first()
    assert row["cohort"].asDict() == {"n_patients": 1, "n_encounters": 2}
    assert row["data_availability"]["lab_results"] == 1 and row["outcomes"]["n_deaths"] == 0
