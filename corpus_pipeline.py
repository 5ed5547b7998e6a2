"""A corpus cleaned and packed for training, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.llm import decontam, language_spans, length_packing, line_dedup, simhash_tiles
from clinspark.llm.store import stored


#: Least share of letters in spans of a document's language.  Documents in two languages, or with quoted passages, stay.
LANGUAGE_SHARE = 1 / 3


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, and those in no learned language for at least a third of their letters: what stands in
    another script, or does not read like the texts of the language found for it, counts for none.

    The model is learned from the documents' own labels; none is changed.  Without any label nothing is known of
    languages, and every document stays."""
    model = language_spans.learn(docs, "doc_id", "text", "lang")
    if not model.langs:
        return docs
    fine = (F.col("_lang_pred") != language_spans.UNDETERMINED) & (F.col("_lang_fitting") >= LANGUAGE_SHARE)
    found = language_spans.language_spans(docs, model, added=("_lang_pred", "_lang_score"), fits=("_lang_fit", "_lang_known", "_lang_fitting"))
    return found.filter(fine).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that a large share of the documents of one source repeat; every document stays."""
    return line_dedup.without_boilerplate(docs, host="source", text="text", added=())


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, ``_row``, stored so that it stays the same; ids may repeat or be missing."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "row-keys")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that of the smallest id, rows without an id last, and of equal ids the first."""
    rows = with_row_keys(docs)
    # keys in the order in which rows are chosen, so that the smallest of a group is the one that stays
    key = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    found = simhash_tiles.near_duplicates(rows.select(key.alias("doc_id"), "text"), shingle=4, radius=4)
    gone = found.filter("id.row <> component_id.row").select(F.col("id.row").alias("_gone"))
    return rows.join(gone, rows["_row"] == gone["_gone"], "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that hold a benchmark item, each looked at by itself, whatever its id."""
    rows = with_row_keys(docs)
    found = decontam.contained(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="_row")
    leaks = found.select(F.col("doc_id").alias("_leak")).distinct()
    return rows.join(leaks, rows["_row"] == leaks["_leak"], "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each training sequence: its bucket, batch and slot."""
    return length_packing.packed(docs)


STAGES = [
    ("language ID", keep_known_language),
    ("line dedup", drop_boilerplate),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: The first and third stage cannot be expressed in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
