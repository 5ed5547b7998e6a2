"""Reading rule files and tables, writing results."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clinspark import config
from clinspark import fixed_values as fv
from clinspark.config import SiteConfig, site_a, site_b
from clinspark.operators import comorbidity as cm
from clinspark.operators import hcc as hc
from clinspark.plans.adapter import Warehouse
from clinspark.sources import mappings as mp
from clinspark.sources import tables as tb


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_crosswalk(spark, tmp_path):
    path = tmp_path / "crosswalk.txt"
    path.write_text("a41.9 \t2\nA419\t2\nE1122\t 37\nE1122\t38\n\nbroken\n")
    assert rows_of(mp.hcc_crosswalk(spark, str(path))) == [("A419", 2), ("E1122", 37), ("E1122", 38)]


def test_hierarchy_text(spark, tmp_path):
    path = tmp_path / "rules.txt"
    path.write_text(
        " %MACRO SET0( CC=, HIER= );\n /*one */ %SET0(CC=17    , HIER=%STR(18, 19 ));\n"
        " /*two */ %SET0(CC=191   , HIER=%STR(\n180, 181,\n 254 ));\n"
    )
    got = rows_of(mp.hcc_hierarchy(spark, str(path)))
    assert got == [(0, 17, [18, 19]), (1, 191, [180, 181, 254])]


def test_coefficients(spark, tmp_path):
    path = tmp_path / "coefs.csv"
    path.write_text(
        "name,coef,label\nCNA_HCC17, 2.341 ,\"a, b\"\nCNA_D10P,1.1,\nCNA_DIABETES_HF_V28,0.11,\n"
        "CNA_F65_69,0.3,\nCND_HCC17,9,\nSNPNE_NMCAID_NORIGDIS_NEF65,0.7,\n"
    )
    assert rows_of(mp.hcc_coefficients(spark, str(path))) == [
        ("D10P", "count", 1.1), ("DIABETES_HF_V28", "interaction", 0.11), ("HCC17", "hcc", 2.341),
    ]


def test_a_coefficient_that_is_no_number_fails(spark, tmp_path):
    path = tmp_path / "coefs.csv"
    path.write_text("name,coef,label\nCNA_HCC17,2.3,x\nCNA_HCC18,bad,x\n")
    with pytest.raises(Exception, match="CNA_HCC18 = bad"):
        mp.hcc_coefficients(spark, str(path)).collect()


def test_rule_files_feed_the_operators(spark, rows, tmp_path):
    """Rules, coefficients and labels as they are read give what the literals give, and nothing is collected on the way."""
    (tmp_path / "rules.txt").write_text("".join(
        f" %SET0(CC={p} , HIER=%STR({', '.join(map(str, c))} ));\n" for p, c in fv.HCC_HIERARCHY
    ))
    rules = mp.hcc_hierarchy(spark, str(tmp_path / "rules.txt"))
    sets = rows("i int, cc array<int>", (1, [62, 63, 202]), (2, [17, 18, 19, 20]), (3, []), (4, [221, 226, 35, 36, 37]))
    sets = sets.withColumn("rules", hc.rule_table(rules))
    got = sets.select("i", hc.apply_hierarchy(F.col("cc"), F.col("rules")).alias("h"), hc.apply_hierarchy(F.col("cc")).alias("w")).collect()
    assert len(got) == 4 and all(r["h"] == r["w"] for r in got)
    terms = [("CNA", "HCC17", 1.5), ("CND", "HCC17", 2.0), ("INS", "HCC17", 0.5), ("NE", "NMCAID_NORIGDIS_NEF65", 0.25), ("SNPNE", "NMCAID_NORIGDIS_NEF65", 0.75), ("CNA", "F65_69", 0.125)]
    (tmp_path / "coefs.csv").write_text("name,coef,label\n" + "".join(f"{s}_{f},{c},x\n" for s, f, c in terms))
    read = mp.hcc_segment_coefficients(spark, str(tmp_path / "coefs.csv"))
    literal = rows("segment string, feature string, coef double", *terms)
    person = hc.demographics(
        rows("p int, birthdate date, sex string, orec string, nemcaid int, ltimcaid int", (1, dt.date(1950, 1, 1), "2", "0", 0, 0)),
        F.lit("2015-02-01").cast("date"),
    )
    final = rows("p int, hcc array<int>", (1, [17]))
    scores = [rows_of(hc.segment_scores(final, person, table, "p")) for table in (read, literal)]
    assert scores[0] == scores[1] and scores[0][0][1] == 1.625
    (tmp_path / "labels.txt").write_text(' HCC17 ="Cancer "\n')
    labels = mp.hcc_labels(spark, str(tmp_path / "labels.txt")).selectExpr("concat('HCC', hcc) AS category", "label")
    long = rows("encounterkey int, category string, poa boolean", (1, "HCC17", True), (2, "HCC18", False))
    assert rows_of(cm.prevalence(long, long, labels), "category", "label", "n") == [("HCC17", "Cancer", 1), ("HCC18", "HCC18", 1)]


def test_labels(spark, tmp_path):
    path = tmp_path / "labels.txt"
    path.write_text(' LABEL\n HCC1 ="HIV/AIDS "\n HCC51 ="Addison\'s and Cushing\'s Diseases "\n CC1 ="HIV/AIDS "\n ;\n')
    assert rows_of(mp.hcc_labels(spark, str(path))) == [(1, "HIV/AIDS"), (51, "Addison's and Cushing's Diseases")]


def test_ccsr_rows(rows):
    df = rows("code string, c1 string, d1 string, c2 string, d2 string", ("'A00'", "'DIG001'", "Infection", "' '", ""), ("'A00'", "'DIG001'", "Infection", "'INF003'", "Bacteria"))
    assert rows_of(mp.ccsr_mapping(df, "code", ["c1", "c2"])) == [("A00", "DIG001"), ("A00", "INF003")]
    assert rows_of(mp.ccsr_labels(df, [("c1", "d1"), ("c2", "d2")])) == [("DIG001", "Infection"), ("INF003", "Bacteria")]


def test_item_keys(spark):
    assert mp.item_keys(spark, site_a("x"), "lab").where("item_key = 994").first()["item"] == "WBC Count"
    assert mp.item_keys(spark, site_b("x"), "assess").where("item = 'BP'").first()["item_key"] == 27705


def test_register_asset_skips_and_tolerates(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "goodfact"))
    spark.range(3).write.parquet(str(tmp_path / "fmreportproperty"))
    (tmp_path / "emptyfact").mkdir()
    (tmp_path / "damagedfact").mkdir()
    (tmp_path / "damagedfact" / "part-0.parquet").write_text("no parquet at all")
    (tmp_path / "note.txt").write_text("no table")
    site = SiteConfig("s", str(tmp_path), "ED")
    with pytest.warns(UserWarning) as told:
        assert tb.register_asset(spark, site) == ["goodfact"]
    assert {str(w.message).split()[1] for w in told} == {"emptyfact", "damagedfact"}
    assert spark.table("goodfact").count() == 3
    spark.catalog.dropTempView("goodfact")


def test_load_optional(spark, tmp_path):
    missing = tb.load_optional(spark, str(tmp_path / "none.parquet"), "encounterkey long, value string")
    assert missing.count() == 0 and missing.columns == ["encounterkey", "value"]


def test_write_result_in_both_formats(spark, rows, tmp_path):
    df = rows("a int, b string", (1, "x"), (2, None))
    tb.write_result(df, str(tmp_path), "res")
    assert rows_of(spark.read.parquet(str(tmp_path / "res.parquet")), "a") == [(1,), (2,)]
    assert rows_of(tb.read_csv_columns(spark, str(tmp_path / "res.csv"), ["a"])) == [("1",), ("2",)]


AWKWARD = [(1, "line\nbreak"), (2, 'say "hi", ok'), (3, ""), (4, None), (5, " spaces "), (6, "back\\slash\\"), (7, "a\r\nb")]


@pytest.mark.parametrize("formats", [("parquet", "csv"), ("csv", "parquet"), ("csv",)])
def test_texts_survive_every_format(spark, rows, tmp_path, formats):
    tb.write_result(rows("a int, b string", *AWKWARD), str(tmp_path), "res", formats)
    for form in formats:
        path = str(tmp_path / f"res.{form}")
        back = spark.read.parquet(path) if form == "parquet" else tb.read_csv_columns(spark, path, ["a", "b"], "a int, b string")
        assert sorted(map(tuple, back.collect())) == AWKWARD


def test_files_without_line_breaks_are_read_in_many_tasks(spark, rows, tmp_path):
    lines = ["a,b"] + [f'{i},"say ""{i}"", ok"' if i % 3 else f'{i},""' if i % 2 else f"{i}," for i in range(20_000)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    path, before = str(tmp_path / "big.csv"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        whole = tb.read_csv_columns(spark, path, ["a", "b"], "a int, b string")
        split = tb.read_csv_columns(spark, path, ["a", "b"], "a int, b string", line_breaks=False)
        tasks = [frame.select(F.spark_partition_id().alias("p")).distinct().count() for frame in (whole, split)]
        assert tasks[0] == 1 and tasks[1] > 4
        assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect())) and split.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("row", AWKWARD)
def test_line_breaks_are_refused_where_files_are_split(spark, rows, tmp_path, row):
    tb.write_result(rows("a int, b string", row, (9, "plain")), str(tmp_path), "res", ("csv",))
    back = tb.read_csv_columns(spark, str(tmp_path / "res.csv"), ["a", "b"], "a int, b string", line_breaks=False)
    if row[1] and "\n" in row[1]:
        with pytest.raises(Exception, match="line break inside a text"):
            back.collect()
    else:
        assert sorted(map(tuple, back.collect())) == [row, (9, "plain")]


def test_write_json(rows, tmp_path):
    tb.write_json(rows("a int", (7,)), str(tmp_path / "j"))
    part = next((tmp_path / "j").glob("part-*.json"))
    assert json.loads(part.read_text()) == {"a": 7}


def test_publish_database(spark, rows, tmp_path):
    saved = tb.publish_database({"one": rows("a int", (1,)), "two": None}, "site_out", spark, f"{tmp_path}/db")
    assert (tmp_path / "db" / "one").is_dir()
    assert saved == ["one"] and spark.table("site_out.one").count() == 1
    spark.sql("DROP DATABASE site_out CASCADE")


def test_union_fills_missing_columns(rows):
    both = tb.union_sites({"a": rows("k int, x int", (1, 2)), "b": rows("k int", (3,))})
    assert rows_of(both, "k", "source") == [(1, "a"), (3, "b")] and both.where("x is null").count() == 1


def test_shuffle_partitions_follow_the_bytes_of_the_tables_read(spark, tmp_path):
    """However large the tables, one partition of a shuffle stays small; small tables get what the session sets."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(200_000).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    before, least = config.BYTES_PER_PARTITION, int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert Warehouse(spark, str(tmp_path))["orders"].count() == 200_000
        assert int(spark.conf.get(name)) == least
        config.BYTES_PER_PARTITION = 1000
        Warehouse(spark, str(tmp_path))["orders"]
        assert int(spark.conf.get(name)) == tb.stored_bytes(spark, f"{tmp_path}/orders.parquet") // 1000 > least
    finally:
        config.BYTES_PER_PARTITION = before
        spark.conf.unset(name)
