import duckdb
import pytest
from llm_brute import without_boilerplate
from oracle_check import compare

from clinspark.llm import line_dedup as ld
from clinspark.llm.queries import ORACLES, QUERIES

ROWS = (
    [(i, "a", f"head\nown {i}\n\n tail ") for i in range(20)]
    + [(100 + i, "a", f"rare\nmore {i}") for i in range(4)]
    + [(200 + i, "b", "head\nhead\nhead") for i in range(4)]
    + [(300, None, "head"), (301, "a", None), (302, "a", ""), (303, "c", "x\n" * 30_000), (304, "a", "head\nown 1"), (304, "a", "head\nown 1")]
)


def test_lines_equal_brute_force(spark):
    frame = spark.createDataFrame([(*r, "y") for r in ROWS], "doc_id long, host string, text string, lines string")
    got = ld.without_boilerplate(frame).toPandas()
    assert list(got.columns) == ["doc_id", "host", "text", "lines", "n_lines", "n_dropped"] and set(got["lines"]) == {"y"}
    expected = sorted((i, str(t), n) for (i, _, _), (t, n) in zip(ROWS, without_boilerplate([r[1:] for r in ROWS])))
    assert sorted(zip(got["doc_id"], map(str, got["text"]), got["n_dropped"])) == expected


def test_large_tables_of_lines_are_joined_by_shuffle(spark, monkeypatch):
    frame = spark.createDataFrame(ROWS, "doc_id long, host string, text string")
    whole = sorted(map(str, ld.without_boilerplate(frame).collect()))
    monkeypatch.setattr(ld, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(ld, "BROADCAST_CHARS", -1)
    assert sorted(map(str, ld.without_boilerplate(frame).collect())) == whole


def test_empty(spark):
    assert ld.without_boilerplate(spark.createDataFrame([], "host string, text string")).count() == 0


def test_page_lines(spark):
    rows = [
        (1, "HTTP://u:p@Www.A.example:80/x?y", "<p>One<br>two <b>three</b><script>var a='</p>';</script></p><!-- no -->four"),
        (2, "no url", None), (3, None, ""),
    ]
    got = ld.page_lines(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()
    assert [(r["host"], r["text"]) for r in got] == [("www.a.example", "\nOne\ntwo three\nfour"), (None, None), (None, "")]


def test_query_has_no_python_and_equals_its_oracle(spark):
    folder = "/root/testdata/sf0.001"
    frame = QUERIES["op3_line_dedup"](spark, folder)
    assert "Python" not in frame._jdf.queryExecution().toString() and "InPandas" not in frame._jdf.queryExecution().toString()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    assert compare(frame.toPandas(), con.execute(ORACLES["op3_line_dedup"]).df()) is None


def test_the_ratio_decides_on_small_hosts_too(spark):
    rows = [(i, "s", f"menu\nown {i}\n{'(c)' if i < 3 else 'x'}") for i in range(4)]
    rows += [(10 + i, "copies", "head\nbody") for i in range(4)] + [(20, "one", "alone"), (21, None, "menu")]
    rows += [(30 + i, "more", f"own {i}\n{'pair' if i < 2 else i}") for i in range(20)] + [(60 + i, "large", f"{'menu' if i < 9 else 'x'} \nown {i}") for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, host string, text string")
    dropped = {(r["doc_id"], r["n_dropped"]) for r in ld.without_boilerplate(frame).collect() if r["n_dropped"]}
    # 100 pages: menu on 9 and x on 91 are over 8 %; 20 pages: a line on 2 of them is not surely so; copies are one page
    assert dropped == {(0, 2), (1, 2), (2, 2), (3, 1)} | {(60 + i, 1) for i in range(100)}


@pytest.mark.parametrize("name", ["op3_line_dedup", "op3_line_dedup_few"])
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_drops_lines_and_equals_its_oracle(spark, size, name):
    folder = f"/root/testdata/{size}"
    got = QUERIES[name](spark, folder).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    assert compare(got, con.execute(ORACLES[name]).df()) is None
    assert size == "sf0.001" or got["n_dropped"].sum() > 0
