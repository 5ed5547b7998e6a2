"""The queries of this subpackage over the given tables, and their DuckDB texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.llm import (
    chat_links,
    decontam,
    fill_middle,
    hmm_lm,
    language_spans,
    length_packing,
    line_dedup,
    mixing,
    prefix_trie,
    simhash_tiles,
    subspace_join,
    suffix_dedup,
    token_files,
)
from clinspark.llm.store import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if oracle:
            ORACLES[name] = oracle
        return plan

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# the second name is that of a version beside one that kept every line on fewer than five pages
@_query("op3_line_dedup_few", line_dedup.ORACLE)
@_query("op3_line_dedup", line_dedup.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = line_dedup.page_lines(_read(spark, sf_dir, "pages")).select("page_id", "host", "text")
    # the operator reads its pages three times; their markup is taken off once
    cut = line_dedup.without_boilerplate(stored(pages, "page-text"))
    return cut.select("page_id", "host", "n_lines", "n_dropped", "text")


@_query("op4_simhash_tiles")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_tiles.near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op5_decontam", decontam.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@_query("op6_length_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_packing.packed(_read(spark, sf_dir, "documents"))


@_query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(_read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query("op9_subspace_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = subspace_join.near_vectors(_read(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


@_query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(_read(spark, sf_dir, "documents"), path, with_ids=False)


@_query("op10_language_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = language_spans.learn(docs.filter(fold != 0), "doc_id", "text", "lang")
    found = language_spans.language_spans(docs.select("doc_id", "text"), model, added=("lang_pred", "score"))
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@_query("op2_chat_links", chat_links.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat_links.calls_of_turns(_read(spark, sf_dir, "conversations"))
    return chat_links.linked(calls, results, chat_links.TURN_TOOLS)


@_query("op7_hmm_lm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    found = hmm_lm.scored(docs, fold != 2)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query("op11_prefix_trie", prefix_trie.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    ids = prefix_trie.conversation_ids(rows)
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.numbered_turns(rows), ids), ids)


@_query("op12_fill_middle", fill_middle.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(_read(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


@_query("op13_mixing", mixing.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.placed_documents(_read(spark, sf_dir, "documents"))
    return mixing.taken(placed, mixing.mixed(placed))
