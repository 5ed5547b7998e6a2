"""Column resolution, parsing and scalar rules on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions import columns as c
from clinspark.functions import scalars as s
from clinspark.functions.quantiles import numeric_profile


def one(df):
    return [tuple(r) for r in df.collect()]


def test_candidate_order_decides_not_column_order(rows):
    df = rows("NumericValue string, VALUE string", ("1", "2"))
    assert c.resolve_column(df, ["value", "numericvalue"]) == "VALUE"
    assert c.resolve_column(df, ["other"]) is None
    with pytest.raises(ValueError):
        c.require_column(df, ["other"], "value")


def test_time_from_instant_or_pair(rows):
    pair = rows("d date, t string", (dt.date(2024, 1, 2), "13:45"), (dt.date(2024, 1, 2), "bad"), (None, "10:00"))
    times = [r[0] for r in pair.select(c.resolve_time(pair, ["x"], [("d", "t")])).collect()]
    assert times == [dt.datetime(2024, 1, 2, 13, 45), None, None]
    alone = pair.select("d")
    midnight = alone.select(c.resolve_time(alone, [], [("d", "t")])).first()[0]
    assert midnight == dt.datetime(2024, 1, 2)
    text = rows("i string", ("2024-01-02 03:04:05",), ("never",))
    assert [r[0] for r in text.select(c.resolve_time(text, ["i"], [])).collect()] == [
        dt.datetime(2024, 1, 2, 3, 4, 5), None,
    ]


@pytest.mark.parametrize(
    "text, value",
    [("12.5", 12.5), (" 7 ", 7.0), ("1e2", 100.0), ("PENDING", None), ("12d", None), ("NaN", None), ("", None), (None, None)],
)
def test_number_parse(rows, text, value):
    assert rows("v string", (text,)).select(c.to_number(F.col("v"))).first()[0] == value


def test_nan_is_missing(rows):
    df = rows("value double", (float("nan"),), (3.0,))
    assert [r[0] for r in df.select(c.resolve_numeric(df, ["value"])).collect()] == [None, 3.0]


def test_blood_pressure(rows):
    df = rows("v string", ("120/80",), ("95",), ("x/80",), (None,))
    assert [r[0] for r in df.select(s.systolic(F.col("v"))).collect()] == [120.0, 95.0, None, None]
    top, bottom, mean = s.bp_parts(F.col("v"))
    got = one(df.select(top, bottom, mean))
    assert got[0] == (120.0, 80.0, pytest.approx(280 / 3))
    assert got[1] == (95.0, None, None) and got[2] == (None, 80.0, None)


def test_temperature_units(rows):
    df = rows("v double", (98.6,), (37.0,), (31.0,), (120.0,), (42.0,))
    got = [r[0] for r in df.select(s.normalise_temp(F.col("v"))).collect()]
    assert got == [pytest.approx(37.0), 37.0, None, None, 42.0]


def test_calendar_age_counts_year_boundaries(rows):
    df = rows("b date, a date", (dt.date(2000, 12, 31), dt.date(2018, 1, 1)))
    got = df.select(s.age_years(F.col("b"), F.col("a")), s.age_completed(F.col("b"), F.col("a"))).first()
    assert tuple(got) == (18, 17)


def test_icd_spellings(rows):
    df = rows("v string", (" a41.9",))
    assert tuple(df.select(s.normalise_icd(F.col("v"), "dots"), s.normalise_icd(F.col("v"))).first()) == (" a419", "A419")


def test_admission_evidence_is_never_null(rows):
    df = rows("p string, t string", ("YES", None), (None, "Problem List"), (None, None), ("No", "Encounter"))
    assert [r[0] for r in df.select(s.poa_qualified(F.col("p"), F.col("t"))).collect()] == [True, True, False, False]


def test_placeholders(rows):
    df = rows("a string, n int", ("unknown race", 1), ("Declined", 2), ("*x", 3), ("", 4), ("White", 5))
    got = one(s.null_placeholders(df, [fv.UNKNOWN_TEXT, fv.BLANK_TEXT]))
    assert [r[0] for r in got] == [None, None, None, None, "White"]


def test_bands_at_their_limits(rows):
    df = rows("v double", (8.0,), (8.5,), (20.0,), (24.0,), (25.0,), (None,))
    assert [r[0] for r in df.select(s.band_points(F.col("v"), fv.NEWS_RESP)).collect()] == [3, 1, 0, 2, 3, None]


def test_profile_matches_builtin_percentile(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1301 / 7.0).alias("v"))
    df = df.withColumn("v", F.when(F.col("v") % 5 < 4.5, F.col("v")))
    got = {r["g"]: r for r in numeric_profile(df, ["g"], "v").collect()}
    want = df.groupBy("g").agg(
        F.count("v").alias("n"), (F.count("*") - F.count("v")).alias("missing"), F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("sd"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.percentile("v", 0.25).alias("q25"), F.percentile("v", 0.5).alias("median"), F.percentile("v", 0.75).alias("q75"),
    )
    for row in want.collect():
        for name in row.asDict():
            assert got[row["g"]][name] == pytest.approx(row[name]), name


def test_profile_over_all_sizes_of_numbers(rows):
    values = [0.0, -0.0, 5e-324, -5e-324, 1e-300, -1e-300, 1.0, -1.0, 1.0000000001, 3.5, 3.5, -7.25, 1.7e308, -1.7e308, float("inf"), float("-inf"), 2.0, None]
    shares = [i / 16 for i in range(17)]
    got = numeric_profile(rows("v double, w int", *[(v, i) for i, v in enumerate(values)]), [], "v", {f"p{i}": p for i, p in enumerate(shares)}, sums={"w": F.col("w") % 3}).first()
    ordered = sorted(v for v in values if v is not None)
    assert [got[f"p{i}"] for i in range(1, 16)] == ordered[1:16] and got["n"] == 17 and got["w"] == sum(i % 3 for i in range(18))


def test_profile_with_one_value_holding_most_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    row = numeric_profile(df, [], "v").first()
    assert (row["n"], row["median"], row["q75"]) == (3000, 5.0, pytest.approx(2249.25))


@pytest.mark.parametrize("ranges", [None, 2, 300])
def test_nan_is_no_value_in_a_profile(rows, ranges):
    row = numeric_profile(rows("v double", (1.0,), (2.0,), (float("nan"),), (None,)), [], "v", ranges=ranges).first()
    assert (row["n"], row["missing"], row["mean"], row["median"], row["max"]) == (2, 2, 1.5, 1.5, 2.0)


def test_profile_without_values(rows):
    row = numeric_profile(rows("v double", (None,), (None,)), [], "v").first()
    assert (row["n"], row["missing"], row["mean"], row["median"]) == (0, 2, None, None)


def test_profile_keeps_the_missing_group(rows):
    df = rows("g string, v double", (None, 1.0), (None, 3.0), ("a", 5.0))
    got = sorted((str(r["g"]), r["n"], r["median"]) for r in numeric_profile(df, ["g"], "v").collect())
    assert got == [("None", 2, 2.0), ("a", 1, 5.0)]


def test_profile_of_no_rows(rows):
    df = rows("v double", (1.0,)).where("v > 5")
    assert tuple(numeric_profile(df, [], "v").select("n", "missing", "median").first()) == (0, 0, None)


def test_published_ranges_expand_to_the_published_number_of_prefixes():
    prefixes = [p for listed in fv.QUAN_CODES.values() for p in listed]
    assert len(prefixes) == 399 and {len(p) for p in prefixes} == {3, 4}
    assert set(fv.QUAN_CODES) == set(fv.VW_WEIGHTS_QUAN)


def test_key_set_sizes():
    sizes = [len(k) for k in (fv.LAB_KEYS_A, fv.LAB_KEYS_B, fv.ASSESS_KEYS_A, fv.RESP_KEYS_A, fv.ASSESS_KEYS_B, fv.RESP_KEYS_B)]
    assert sizes == [51, 50, 18, 21, 27, 23]
    assert len(fv.CONCEPTS) == 74 and sum(map(len, fv.CONCEPTS.values())) == 167
