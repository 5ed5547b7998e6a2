import importlib.util

import pytest
from llm_brute import contained, near_copies, without_boilerplate
from pyspark.sql import functions as F
from test_length_packing import check

import corpus_pipeline as cp
from clinspark.llm import language_spans

FOLDER = "/root/testdata/sf0.001"


def brute(spark, rows):
    """Rows of (doc_id, text, lang, source) that are left before packing."""
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labeller = language_spans.Labeller(language_spans.learn(frame, "doc_id", "text", "lang"), 8.0)
    rows = [r for r, (lang, score, _) in zip(rows, labeller.label([r[1] for r in rows])) if lang != "und" and score >= cp.LANGUAGE_SHARE]
    rows = [(r[0], t, r[2], r[3]) for r, (t, _) in zip(rows, without_boilerplate([(r[3], r[1]) for r in rows]))]
    rows.sort()
    rows = [r for r, (_, c) in zip(rows, near_copies([r[0] for r in rows], [r[1] for r in rows])) if c == r[0]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {d for d, *_ in contained([(r[0], r[1]) for r in rows], items)}
    return [r for r in rows if r[0] not in leaks]


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    left = brute(spark, rows)
    assert 100 < len(left) < len(rows)
    check([r[:2] for r in left], cp.run(spark, FOLDER).toPandas(), 8, 2048, 65_536)


def test_stages_keep_the_columns_and_native_ones_run_no_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumns({"n_lines": F.lit(1), "score": F.lit("s"), "id": F.lit(2), "extra": F.array(F.lit(1))})
    for name, stage in cp.STAGES[:-1]:
        made = stage(spark, docs, FOLDER)
        assert made.schema.simpleString() == docs.schema.simpleString(), name
        plan = made._jdf.queryExecution().toString()
        assert name not in ("line dedup", "benchmark decontamination") or ("InPandas" not in plan and "InArrow" not in plan)
    assert [n for n, _ in cp.STAGES] == ["language ID", "line dedup", "simhash near-dedup", "benchmark decontamination", "packing"]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None), (1, None, "en", "a"), (1, "", None, None), (2, "one two three", "en", "a"), (2, "one two three", "en", "a"), (None, "some more words", "en", None)]])
def test_stages_take_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, FOLDER).count() <= 2 * len(rows)


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names) and importlib.util.find_spec("corpus_pipeline")


def test_language_stage_drops_what_no_learned_language_fits(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source")
    texts = {k: [r["text"] for r in docs.filter(F.col("lang") == k).orderBy("doc_id").limit(8).collect()] for k in ("en", "de", "es")}
    part = lambda k, n: " ".join(" ".join(texts[k]).split()[:n])
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava"
    russian = "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью и должны поступать"
    letters = " ".join(str(i * 7919 % 99991).translate(str.maketrans("0123456789", "qxzjkvwpyh")) for i in range(200))
    bad = [finnish * 3, russian * 3, "漢字仮名交文 " * 50, letters, "1 2 3"]
    good = [part("en", 60) + " " + part("de", 60), part("en", 60) + " " + part("es", 60), part("de", 60) + " " + russian, part("en", 3), part("es", 20)]
    rows = [(10**6 + i, t, None, "x") for i, t in enumerate(bad)] + [(2 * 10**6 + i, t, None, "x") for i, t in enumerate(good)]
    left = cp.keep_known_language(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), FOLDER)
    ids = {r["doc_id"] for r in left.collect()}
    assert {i for i in ids if i >= 10**6} == {2 * 10**6 + i for i in range(len(good))}
    assert len(ids) == docs.count() + len(good)


SOME, OTHER = " ".join(f"word{i}" for i in range(40)), " ".join(f"other{i}" for i in range(40))
THIRD = " ".join(f"third{i}" for i in range(40))


def left_by(spark, stage, rows):
    docs = spark.createDataFrame([(*r, "en", "a") for r in rows], "doc_id long, text string, lang string, source string")
    return sorted(((r["doc_id"], r["text"]) for r in stage(spark, docs, FOLDER).collect()), key=str)


def test_near_dedup_tells_rows_apart(spark):
    rows = [(1, SOME), (1, SOME), (2, OTHER), (2, SOME), (None, SOME), (None, THIRD), (None, THIRD)]
    assert left_by(spark, cp.drop_near_copies, rows) == sorted([(1, SOME), (2, OTHER), (None, THIRD)], key=str)


def test_decontamination_tells_rows_apart(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, f"{SOME} {item}"), (None, SOME), (None, OTHER), (3, f"{THIRD} {item}"), (3, THIRD), (4, item), (5, OTHER)]
    assert left_by(spark, cp.drop_benchmark_leaks, rows) == sorted([(None, SOME), (None, OTHER), (3, THIRD), (5, OTHER)], key=str)
