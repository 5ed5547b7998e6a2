"""Sepsis-related diagnosis classes and department classes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.scalars import icu_flag

NO_CLASS = None


def _code_in(code: Column, prefixes: Sequence[str]) -> Column:
    return code.rlike("^(" + "|".join(re.escape(p) for p in prefixes) + ")")


def _has(text: Column, words: Sequence[str]) -> Column:
    return text.rlike("|".join(words))


def _mentions(text: Column, word: str) -> Column:
    """The word is there and not ruled out by an earlier WITHOUT."""
    return text.contains(word) & ~text.rlike(fv.RULED_OUT + word)


def sepsis_category(
    code: Column, name: Column, l1: Column, l2: Column, l3: Column
) -> Column:
    """Class of a diagnosis by its code and names, null when it is none of them.

    The rules are tried in order and the first that holds decides.
    """
    code, name, l1, l2, l3 = (F.coalesce(F.upper(c), F.lit("")) for c in (code, name, l1, l2, l3))
    text = F.concat_ws(" ", code, name, l1, l2, l3)
    rules = [
        (_code_in(code, fv.DX_EXCLUDED_CODES), NO_CLASS),
        (
            _code_in(code, fv.DX_SEPSIS_CODES)
            | (~name.contains("ASEPTIC") & _has(name, fv.DX_SEPSIS_WORDS)),
            "sepsis_bacteremia",
        ),
        (
            _code_in(code, fv.DX_RESPIRATORY_CODES)
            | (text.contains("PNEUMONIA") & ~text.contains("CRYPTOGENIC"))
            | text.contains("EMPYEMA"),
            "infection_respiratory",
        ),
        (_code_in(code, fv.DX_URINARY_CODES) | _has(text, fv.DX_URINARY_WORDS), "infection_urinary"),
        (_code_in(code, fv.DX_ABDOMINAL_CODES) | _has(text, fv.DX_ABDOMINAL_WORDS), "infection_abdominal"),
        (
            _code_in(code, fv.DX_SKIN_CODES)
            | _has(text, fv.DX_SKIN_WORDS)
            | _mentions(text, "ABSCESS")
            | (_mentions(text, "GANGRENE") & ~_code_in(code, fv.DX_VASCULAR_CODES)),
            "infection_skin",
        ),
        (_code_in(code, fv.DX_NONBACTERIAL_CODES), NO_CLASS),
        (
            _code_in(code, fv.DX_OTHER_CODES)
            | (~text.contains("NONPYOGENIC") & _has(text, fv.DX_OTHER_WORDS)),
            "infection_other",
        ),
        (_code_in(code, fv.DX_SHOCK_CODES) | name.contains("SHOCK"), "shock"),
        (
            _code_in(code, fv.DX_ORGAN_CODES)
            | code.isin(fv.DX_ORGAN_EXACT_CODES)
            | _has(text, fv.DX_ORGAN_WORDS)
            | text.rlike(r"\b(" + "|".join(fv.DX_ORGAN_WHOLE_WORDS) + r")\b"),
            "organ_dysfunction",
        ),
        (
            _code_in(code, fv.DX_FEVER_CODES) | (name.contains("FEVER") & ~name.contains("WITHOUT FEVER")),
            "fever",
        ),
    ]
    return reduce(
        lambda chain, rule: F.when(rule[0], F.lit(rule[1])).otherwise(chain),
        reversed(rules),
        F.lit(None).cast("string"),
    )


def top_icd_codes(dx: DataFrame, n: int | None = 5000) -> DataFrame:
    """The ``n`` most frequent codes, or all, with their commonest name, type, hierarchy names and class.

    Events are first counted per code and name, so a frequent code is small before its name is chosen.
    Of equally common names the first in order is taken, and of differing types or levels the lowest.
    """
    kept = ["icd_type", "icd_l1_name", "icd_l2_name", "icd_l3_name"]
    by_name = (
        dx.where(F.col("icd_value").isNotNull())
        .groupBy("icd_value", "diagnosisname")
        .agg(F.count("*").alias("c"), *[F.min(k).alias(k) for k in kept])
    )
    ranked = F.when(F.col("diagnosisname").isNotNull(), F.struct((-F.col("c")).alias("c"), "diagnosisname"))
    codes = by_name.groupBy("icd_value").agg(
        F.min(ranked)["diagnosisname"].alias("diagnosisname"),
        F.sum("c").alias("count"),
        *[F.min(k).alias(k) for k in kept],
    )
    top = codes if n is None else codes.orderBy(F.desc("count"), "icd_value").limit(n)
    category = sepsis_category(
        *[F.col(c) for c in ("icd_value", "diagnosisname", "icd_l1_name", "icd_l2_name", "icd_l3_name")]
    )
    return top.select("icd_value", "diagnosisname", "count", category.alias("sepsis_category"), *kept)


def department_counts(dx: DataFrame) -> DataFrame:
    """Diagnosis events per department, its specialty and whether it is an intensive care unit."""
    return (
        dx.where(F.col("departmentname").isNotNull())
        .groupBy("departmentname")
        .agg(F.count("*").alias("count"), F.min("departmentspecialty").alias("departmentspecialty"))
        .withColumn("is_icu", icu_flag(F.col("departmentname")))
        .orderBy(F.desc("count"), "departmentname")
    )


def category_counts(codes: DataFrame) -> DataFrame:
    """Number of codes per class; give it all codes, not a list cut at a number of them."""
    return (
        codes.where(F.col("sepsis_category").isNotNull())
        .groupBy("sepsis_category")
        .agg(F.count("*").alias("n"))
    )


def top_codes_per_category(codes: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent codes of each class."""
    window = Window.partitionBy("sepsis_category").orderBy(F.desc("count"), "icd_value")
    return (
        codes.where(F.col("sepsis_category").isNotNull())
        .select("sepsis_category", "icd_value", "diagnosisname", "count")
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
    )
