"""Item keys, code mappings and rule files as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.config import SiteConfig
from clinspark.functions.columns import to_number
from clinspark.functions.scalars import normalise_icd


def item_keys(spark: SparkSession, site: SiteConfig, kind: str) -> DataFrame:
    """Item names and keys of a site: ``lab``, ``assess`` or ``resp``."""
    keys = {"lab": site.lab_keys, "assess": site.assess_keys, "resp": site.resp_keys}[kind]
    return spark.createDataFrame(list(keys.items()), "item string, item_key int")


def matrix_to_long(df: DataFrame, code: str, categories: Sequence[str]) -> DataFrame:
    """A 0/1 matrix of codes by categories as the pairs that are 1."""
    long = df.where(F.col(code).isNotNull()).unpivot(code, list(categories), "category", "member")
    return long.where(F.col("member") == 1).select(F.col(code).alias("icd_code"), "category")


def _unquoted(value: Column) -> Column:
    return F.trim(value, F.lit("' "))


def ccsr_mapping(df: DataFrame, code: str, categories: Sequence[str]) -> DataFrame:
    """Rows with several category columns as distinct pairs of code and category.

    Codes come in single quotes; an empty category is no category.
    """
    cells = F.explode(F.array(*[F.col(c) for c in categories]))
    return (
        df.select(_unquoted(F.col(code)).alias("icd_code"), cells.alias("cell"))
        .select("icd_code", _unquoted(F.col("cell")).alias("category"))
        .where(F.col("category") != "")
        .distinct()
    )


def ccsr_labels(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One description per category, from the (category, description) column pairs."""
    cells = F.array(*[F.struct(F.col(c).alias("category"), F.col(d).alias("label")) for c, d in pairs])
    return (
        df.select(F.explode(cells).alias("c"))
        .select(_unquoted(F.col("c.category")).alias("category"), F.trim("c.label").alias("label"))
        .where(F.col("category") != "")
        .groupBy("category")
        .agg(F.min("label").alias("label"))
    )


def hcc_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (code, category) pairs of a tab-separated crosswalk."""
    raw = spark.read.csv(path, sep="\t", schema="code string, hcc string")
    return (
        raw.select(normalise_icd(F.col("code")).alias("icd_code"), F.trim("hcc").try_cast("int").alias("hcc"))
        .where(F.col("icd_code").isNotNull() & F.col("hcc").isNotNull())
        .distinct()
    )


def hcc_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """Hierarchy rules of a macro text: position in the file, parent, children."""
    text = spark.read.text(path, wholetext=True)
    found = F.arrays_zip(
        F.regexp_extract_all("value", F.lit(fv.HIERARCHY_RULE), 1).alias("parent"),
        F.regexp_extract_all("value", F.lit(fv.HIERARCHY_RULE), 2).alias("children"),
    )
    children = F.filter(
        F.transform(F.split("r.children", ","), lambda c: F.trim(F.translate(c, "\r\n", "  ")).try_cast("int")),
        lambda c: c.isNotNull(),
    )
    return text.select(F.posexplode(found).alias("position", "r")).select(
        "position", F.col("r.parent").cast("int").alias("parent"), children.alias("children")
    )


def _coefficient_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(name, coef)`` of a coefficient file; a coefficient that is no number fails the query that needs it."""
    raw = spark.read.csv(
        path, header=True, encoding="ISO-8859-1", schema="name string, coef string", mode="PERMISSIVE"
    )
    name, number = F.trim("name"), to_number(F.trim("coef"))
    bad = F.raise_error(F.concat(F.lit("coefficient that is no number: "), name, F.lit(" = "), F.coalesce("coef", F.lit(""))))
    return raw.where(F.col("name").isNotNull()).select(name.alias("name"), F.when(number.isNotNull(), number).otherwise(bad).alias("coef"))


def hcc_segment_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """Coefficients of all segments as ``(segment, feature, coef)``, for the segment scores."""
    prefixes = "|".join(sorted({prefix for prefix, _ in fv.HCC_SEGMENTS.values()}, key=len, reverse=True))
    segment = F.regexp_extract("name", f"^({prefixes})_", 1)
    return (
        _coefficient_rows(spark, path)
        .where(segment != "")
        .select(segment.alias("segment"), F.regexp_extract("name", f"^(?:{prefixes})_(.*)$", 1).alias("feature"), "coef")
    )


def hcc_coefficients(spark: SparkSession, path: str, segment: str = "CNA") -> DataFrame:
    """Coefficients of one segment as ``(feature, kind, coef)``; kinds are hcc, interaction and count."""
    raw = _coefficient_rows(spark, path)
    feature = F.regexp_extract("name", f"^{segment}_(.*)$", 1)
    kind = (
        F.when(F.col("feature").rlike(r"^HCC\d+$"), "hcc")
        .when(F.col("feature").rlike(r"^D\d+P?$"), "count")
        .when(F.col("feature").isin(list(fv.HCC_INTERACTIONS)), "interaction")
    )
    return (
        raw.select(feature.alias("feature"), "coef")
        .withColumn("kind", kind)
        .where(F.col("kind").isNotNull())
        .select("feature", "kind", "coef")
    )


def hcc_labels(spark: SparkSession, path: str) -> DataFrame:
    """Category numbers and descriptions of a label text."""
    text = spark.read.text(path, wholetext=True)
    found = F.arrays_zip(
        F.regexp_extract_all("value", F.lit(fv.HCC_LABEL_PATTERN), 1).alias("hcc"),
        F.regexp_extract_all("value", F.lit(fv.HCC_LABEL_PATTERN), 2).alias("label"),
    )
    return text.select(F.explode(found).alias("r")).select(
        F.col("r.hcc").cast("int").alias("hcc"), F.trim("r.label").alias("label")
    )
