import duckdb
import pytest
from llm_brute import contained
from oracle_check import compare

from clinspark.llm import decontam as dc
from clinspark.llm.queries import ORACLES, QUERIES

ITEM = "the quick brown fox jumps over the lazy dog near a river bank today while it rains all day and night long"
WORDS = ITEM.split()
FEW = " ".join(WORDS[:12])


def docs():
    swapped = WORDS.copy()
    swapped[10] = "xx"
    swapped2 = WORDS.copy()
    swapped2[3] = swapped2[12] = "yy"
    rows = [
        (1, "start " + ITEM.upper().replace(" ", ", ") + " end"), (2, " ".join(swapped)), (3, " ".join(swapped2)), (4, ITEM[:40]),
        (5, None), (6, ""), (7, "one two"), (8, "w " * 30_000 + ITEM), (9, FEW), (10, " ".join(WORDS[:11])), (11, "..."), (12, ITEM), (12, ITEM),
    ]
    return rows


ITEMS = [
    (1, ITEM), (2, ITEM + "!"), (3, FEW), (4, "one  two"), (5, None), (6, ""), (7, "ü ä ö ß é è ê unrelated words altogether"), (None, "null id item text that is here"),
    # ids that repeat with different texts, items without id, and items shorter than a shingle
    (8, " ".join(f"left{i}" for i in range(40))), (8, " ".join(f"right{i}" for i in range(40))), (None, " ".join(WORDS[5:15])), (9, "fox"), (9, "lazy dog near"), (10, "s t u v"), (None, "a b c d"),
]
MORE = [
    (20, " ".join([f"left{i}" for i in range(26)] + [f"right{i}" for i in range(26)])), (21, " ".join(f"left{i}" for i in range(40))), (22, "q r s t u v w"), (23, "s t u v"),
    (24, "s t u"), (25, "q null id item text that is here w"), (26, "a b c d e"), (None, "v s t u v"), (27, "fox"),
]


@pytest.mark.parametrize("rows", [dc.BROADCAST_ROWS, -1])
def test_pairs_equal_brute_force(spark, monkeypatch, rows):
    """With the negative bound nothing is broadcast."""
    monkeypatch.setattr(dc, "BROADCAST_ROWS", rows)
    every = docs() + MORE
    d = spark.createDataFrame([(*r, "x", 1) for r in every], "doc_id long, text string, item_id string, h int")
    got = dc.contained(d, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    expected = contained(every, ITEMS)
    assert sorted(((r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in got), key=str) == sorted(expected, key=str)
    assert all(r["containment"] == r["n_shared"] / r["n_item"] <= 1 for r in got)
    found = {e[:2] for e in expected}
    assert (2, 1) not in found and (8, 1) in found and (20, 8) not in found and {(21, 8), (22, 10), (25, None), (None, 10), (27, 9), (1, 9)} <= found


def test_rows_without_id_and_empty_tables(spark):
    d = spark.createDataFrame([(None, ITEM), (None, "other")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.contained(d, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(None, 1), (None, 3), (None, None), (None, 9)}
    assert dc.contained(d.limit(0), items).count() == 0 and dc.contained(d, items.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 5, 16, 17, 25, 64, 70])
def test_sketches_keep_more_than_an_item_may_lack(spark, n):
    text = " ".join(f"w{i}" for i in range(n + 4))
    kept = dc.sketches(spark.createDataFrame([(1, text)], "item_id long, text string"), 0.8, 5).collect()
    lack = n - -(-8 * n // 10)
    assert kept[0]["n"] == n and len(kept) - lack == kept[0]["least"] >= 1


def test_query_has_no_python_and_equals_its_oracle(spark):
    folder = "/root/testdata/sf0.001"
    frame = QUERIES["op5_decontam"](spark, folder)
    assert "InPandas" not in frame._jdf.queryExecution().toString() and "InArrow" not in frame._jdf.queryExecution().toString()
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    assert compare(frame.toPandas(), con.execute(ORACLES["op5_decontam"]).df()) is None


def test_oracle_finds_the_same_for_odd_items(spark):
    every = [r for r in docs() + MORE if r[0] is not None]
    got = dc.contained(spark.createDataFrame(every, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")).toPandas()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", every)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", ITEMS)
    assert compare(got, con.execute(ORACLES["op5_decontam"]).df()) is None
