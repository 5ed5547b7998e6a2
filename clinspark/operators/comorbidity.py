"""Comorbidity categories per encounter: Elixhauser (two mappings) and CCSR, wide and long.

A long table has one row per encounter and category with ``poa``: whether the category also counts
when evidence of presence on admission is asked for.  Both variants come out of one aggregation.

The functions that group codes take either a code set (``icd_code`` beside the encounter), or facts with a
diagnosis key and, in ``codes``, the terminology's codes by that key.  Terminology and mapping are then joined
first, which are both small against the facts, and the facts are never shuffled by code, where one code may hold
much of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.scalars import n_pct, normalise_icd, poa_qualified
from clinspark.operators.extraction import icd10_terms

KEY = "encounterkey"


def dx_code_set(
    dx: DataFrame,
    terms: DataFrame,
    cohort: DataFrame,
    spelling: str = "dots",
    site: str | None = None,
    distinct: bool = True,
) -> DataFrame:
    """ICD-10-CM codes of the cohort's encounters with their admission evidence.

    Diagnosis keys of different sites clash.  By default they are joined as they are, so a code can
    come from another site's row; with ``site`` naming the source column they are joined within a site.
    ``distinct=False`` leaves out the distinct step where the next aggregation makes it needless.
    """
    on = ["diagnosiskey"] if site is None else ["diagnosiskey", site]
    coded = icd10_terms(terms).select(*on, normalise_icd(F.col("value"), spelling).alias("icd_code"))
    codes = (
        dx.join(cohort.select(KEY), KEY, "left_semi")
        .join(coded, on)
        .select(
            KEY, "icd_code", "presentonadmission", "type",
            poa_qualified(F.col("presentonadmission"), F.col("type")).alias("poa_qualified"),
        )
    )
    return codes.distinct() if distinct else codes


def mapping_coverage(dx: DataFrame, mapping: DataFrame) -> DataFrame:
    """How many of the distinct codes the mapping knows."""
    codes = dx.select("icd_code").where(F.col("icd_code").isNotNull()).distinct()
    known = mapping.select("icd_code").distinct().withColumn("known", F.lit(1))
    return codes.join(known, "icd_code", "left").agg(
        F.count("known").alias("mapped"),
        F.count("*").alias("codes"),
        n_pct(F.count("known"), F.count("*"), 4).alias("pct"),
    )


def dx_facts(dx: DataFrame, cohort: DataFrame, site: str | None = None) -> DataFrame:
    """Diagnosis facts of the cohort's encounters by diagnosis key, with their admission evidence."""
    on = ["diagnosiskey"] if site is None else ["diagnosiskey", site]
    evidence = poa_qualified(F.col("presentonadmission"), F.col("type")).alias("poa_qualified")
    return dx.join(cohort.select(KEY), KEY, "left_semi").select(KEY, *on, evidence)


def term_codes(terms: DataFrame, spelling: str = "dots", site: str | None = None) -> DataFrame:
    """ICD-10-CM codes by diagnosis key."""
    on = ["diagnosiskey"] if site is None else ["diagnosiskey", site]
    return icd10_terms(terms).select(*on, normalise_icd(F.col("value"), spelling).alias("icd_code"))


def by_fact_key(mapping: DataFrame, codes: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """The mapping by what facts are joined on, and the names of that: codes as they are, or diagnosis keys."""
    if codes is None:
        return mapping, ["icd_code"]
    on = [c for c in codes.columns if c != "icd_code"]
    return codes.join(mapping, "icd_code").drop("icd_code").distinct(), on


def _evidence() -> Column:
    return (~F.col("poa_dependent") | F.col("poa_qualified")).alias("evidence")


def _matches(dx: DataFrame, mapping: DataFrame, codes: DataFrame | None) -> DataFrame:
    """``(encounter, category, evidence)`` from a mapping with ``category`` and ``poa_dependent``."""
    keyed, on = by_fact_key(mapping, codes)
    return dx.join(keyed, on).select(KEY, "category", _evidence())


def _long(matches: DataFrame) -> DataFrame:
    return matches.groupBy(KEY, "category").agg(F.bool_or("evidence").alias("poa"))


def poa_only(long: DataFrame) -> DataFrame:
    """The rows that count in the present-on-admission variant."""
    return long.where("poa").select(KEY, "category")


def _ahrq_mapping(mapping: DataFrame) -> DataFrame:
    dependent = F.col("category").isin(fv.AHRQ_POA_DEPENDENT)
    merged = reduce(
        lambda chain, item: F.when(F.col("category") == item[0], item[1]).otherwise(chain),
        fv.AHRQ_MERGED.items(),
        F.col("category"),
    )
    return mapping.select("icd_code", merged.alias("category"), dependent.alias("poa_dependent"))


def ahrq_long(dx: DataFrame, mapping: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Refined Elixhauser categories by exact code.

    Whether a category needs evidence is decided on the mapping's own categories, before the two parts
    of cerebrovascular disease are merged.
    """
    return _long(_matches(dx, _ahrq_mapping(mapping), codes))


def quan_prefixes(spark) -> DataFrame:
    """The 399 (prefix, category) rows of the published mapping."""
    rows = [
        (prefix, category, category not in fv.QUAN_POA_EXEMPT)
        for category, prefixes in fv.QUAN_CODES.items()
        for prefix in prefixes
    ]
    return spark.createDataFrame(rows, "prefix string, category string, poa_dependent boolean")


QUAN_LENGTHS = (3, 4)


def _heads(lengths: Sequence[int]) -> Column:
    """The first characters of a code in each of ``lengths``."""
    return F.array_distinct(F.array(*[F.left("icd_code", F.lit(n)) for n in sorted(set(lengths))]))


def _checked(prefixes: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``prefixes``; one of a length that is not looked up would never be found, so it fails the query."""
    sizes = sorted(set(lengths))
    known = F.length("prefix").isin(sizes)
    message = F.concat(F.lit(f"prefix of a length not among {sizes}: "), F.col("prefix"))
    return prefixes.withColumn("prefix", F.when(known, F.col("prefix")).otherwise(F.raise_error(message)))


def prefix_mapping(codes: DataFrame, prefixes: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``prefixes`` as a mapping of the whole codes in ``codes``.

    A code is looked up by its first characters in each of ``lengths``: an equality join instead of a LIKE against
    every prefix.  A prefix of another length would never be found, so it fails the query.
    """
    whole = codes.select("icd_code").distinct()
    headed = whole.select("icd_code", F.explode(_heads(lengths)).alias("prefix"))
    return headed.join(_checked(prefixes, lengths), "prefix").drop("prefix").distinct()


def quan_long(
    dx: DataFrame,
    prefixes: DataFrame | None = None,
    codes: DataFrame | None = None,
    lengths: Sequence[int] = QUAN_LENGTHS,
) -> DataFrame:
    """Elixhauser categories by code prefix; ``lengths`` are those of the prefixes.

    A code set is looked up where it is, with the prefixes broadcast, as a mapping of its codes would read it twice and
    join it by code; prefixes are bounded by the coding system and do not grow with the facts.
    """
    if prefixes is None:
        prefixes = quan_prefixes(dx.sparkSession)
    if codes is not None:
        return _long(_matches(dx, prefix_mapping(codes, prefixes, lengths), codes))
    headed = dx.select(KEY, "poa_qualified", F.explode(_heads(lengths)).alias("prefix"))
    found = headed.join(F.broadcast(_checked(prefixes, lengths)), "prefix")
    return _long(found.select(KEY, "category", _evidence()))


def ccsr_long(dx: DataFrame, mapping: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """CCSR categories; every category needs evidence in the present-on-admission variant."""
    return _long(_matches(dx, mapping.withColumn("poa_dependent", F.lit(True)), codes))


BITS = 60


def _bit(categories: Sequence[str]) -> tuple[Column, Column]:
    """Word and bit of a category, null where it is not listed, as lookups in literal maps."""
    def table(value) -> Column:
        return F.create_map(*[x for i, c in enumerate(categories) for x in (F.lit(c), F.lit(value(i)))])

    category = F.col("category")
    return F.element_at(table(lambda i: i // BITS), category), F.element_at(table(lambda i: 1 << (i % BITS)), category)


def _refused(category: Column) -> Column:
    return F.raise_error(F.concat(F.lit("category without a column: "), category))


def bit_masks(long: DataFrame, categories: Sequence[str], variants: Mapping[str, Column], name: str = "") -> list[Column]:
    """Aggregates that OR the categories of a group together, for each variant the rows where its condition holds.

    A category without a place among ``categories`` fails the query, as it would be lost."""
    word, bit = _bit(categories)
    word = F.coalesce(word, _refused(F.col("category")).cast("int"))
    return [
        F.bit_or(F.when((word == i) & condition, bit)).alias(f"_{name}{variant}{i}")
        for variant, condition in variants.items()
        for i in range((len(categories) + BITS - 1) // BITS)
    ]


def bit_flags(categories: Sequence[str], prefix: str, variant: str, name: str = "") -> list[Column]:
    """The 0/1 columns read off the masks of a variant."""
    return [
        F.when(F.col(f"_{name}{variant}{i // BITS}").bitwiseAND(F.lit(1 << (i % BITS))) != 0, 1)
        .otherwise(0).cast("byte").alias(prefix + c.lower())
        for i, c in enumerate(categories)
    ]


def to_wide(
    long: DataFrame, cohort: DataFrame, categories: Sequence[str], prefix: str = ""
) -> DataFrame:
    """One 0/1 column per category for every encounter of the cohort.

    The categories of an encounter are gathered as bits of a few long values, which is a hash aggregate
    with map-side reduction whatever the number of columns, and the columns are read off the bits.  A category that
    is not listed fails the query.
    """
    masks = long.select(KEY, "category").groupBy(KEY).agg(*bit_masks(long, categories, {"w": F.lit(True)}))
    return cohort.select(KEY).distinct().join(masks, KEY, "left").select(KEY, *bit_flags(categories, prefix, "w"))


def weighted_score(long: DataFrame, cohort: DataFrame, weights: Mapping[str, int]) -> DataFrame:
    """Sum of category weights and number of categories, zero for encounters without any."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    scores = long.groupBy(KEY).agg(
        F.sum(F.coalesce(F.element_at(table, F.col("category")), F.lit(0))).alias("vw_score"),
        F.count("*").alias("n_categories"),
    )
    return (
        cohort.select(KEY)
        .distinct()
        .join(scores, KEY, "left")
        .select(
            KEY,
            F.coalesce("vw_score", F.lit(0)).cast("short").alias("vw_score"),
            F.coalesce("n_categories", F.lit(0)).cast("short").alias("n_categories"),
        )
    )


def elixhauser_features(
    dx: DataFrame,
    cohort: DataFrame,
    ahrq: DataFrame,
    quan: DataFrame | None = None,
    codes: DataFrame | None = None,
    lengths: Sequence[int] = QUAN_LENGTHS,
    categories: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Both Elixhauser mappings in both variants as 0/1 columns, with score and count of each.

    One pass: a fact is joined once with the categories of both mappings, and one aggregation per encounter ORs
    the bits of all four variants.  ``categories`` lists the columns of each mapping, by default those that have
    a weight; a listed category without a weight is a column and counts, and scores nothing.
    """
    weights = {"ahrq": fv.VW_WEIGHTS_AHRQ, "quan": fv.VW_WEIGHTS_QUAN}
    listed = {system: list((categories or weights)[system]) for system in weights}
    if quan is None:
        quan = quan_prefixes(dx.sparkSession)
    by_prefix = prefix_mapping(dx if codes is None else codes, quan, lengths)
    both = _ahrq_mapping(ahrq).withColumn("category", F.concat(F.lit("ahrq_"), "category")).unionByName(
        by_prefix.withColumn("category", F.concat(F.lit("quan_"), "category"))
    )
    names = [f"{system}_{c}" for system in weights for c in listed[system]]
    masks = _matches(dx, both, codes).groupBy(KEY).agg(
        *bit_masks(dx, names, {"all": F.lit(True), "poa": F.col("evidence")})
    )
    wide = cohort.select(KEY).distinct().join(masks, KEY, "left")
    columns, scores = [], []
    for variant in ("all", "poa"):
        # the mapping's name leads a column, the variant comes second
        for flag, name in zip(bit_flags(names, "", variant), names, strict=True):
            system, _, category = name.partition("_")
            columns.append(flag.alias(f"{system}_{variant}_{category.lower()}"))
    for system, table in weights.items():
        for variant in ("all", "poa"):
            prefix = f"{system}_{variant}_"
            flags = {c: F.col(prefix + c.lower()).cast("int") for c in listed[system]}
            weighted = [flag * table[c] for c, flag in flags.items() if table.get(c)]
            scores += [
                reduce(lambda a, b: a + b, weighted, F.lit(0)).cast("short").alias(prefix + "vw_score"),
                reduce(lambda a, b: a + b, flags.values()).cast("byte").alias(prefix + "count"),
            ]
    return wide.select(KEY, *columns).select("*", *scores)


def prevalence(long: DataFrame, cohort: DataFrame, labels: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """Encounters per category, with and without evidence, as count and share of the cohort.

    ``labels`` name the categories, as a dictionary or as a table of ``(category, label)``.
    """
    total = cohort.agg(F.count_distinct(KEY)).scalar()
    counts = long.groupBy("category").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("poa"), True)).alias("n_poa")
    )
    if isinstance(labels, DataFrame):
        named = labels.select("category", "label").dropDuplicates(["category"])
        counts = counts.join(named, "category", "left").withColumn("label", F.coalesce("label", "category"))
    elif labels:
        table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        counts = counts.withColumn(
            "label", F.coalesce(F.element_at(table, F.col("category")), F.col("category"))
        )
    return counts.withColumn("pct", 100.0 * F.col("n") / total).withColumn(
        "pct_poa", 100.0 * F.col("n_poa") / total
    )


def any_category(long: DataFrame, cohort: DataFrame) -> DataFrame:
    """Share of the cohort with at least one category and the mean number, for both variants."""
    per_encounter = long.groupBy(KEY).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("poa"), True)).alias("n_poa")
    )
    total = cohort.agg(F.count_distinct(KEY)).scalar()
    sums = per_encounter.agg(
        F.count("*").alias("any_all"),
        F.count(F.when(F.col("n_poa") > 0, True)).alias("any_poa"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("sum_all"),
        F.coalesce(F.sum("n_poa"), F.lit(0)).alias("sum_poa"),
    )
    variants = F.array(
        *[
            F.struct(F.lit(v).alias("variant"), F.col(f"any_{v}").alias("n_any"), F.col(f"sum_{v}").alias("s"))
            for v in ("all", "poa")
        ]
    )
    return sums.select(F.explode(variants).alias("v")).select(
        "v.variant", "v.n_any", n_pct(F.col("v.n_any"), total, 4).alias("pct_any"),
        (F.col("v.s") / total).alias("mean_categories"),
    )


def all_systems(longs: Mapping[str, DataFrame]) -> DataFrame:
    """Long tables of several systems under one another, with the system in front of each category.

    Where a table has a flag ``all``, the result has it too; rows of tables without it are all of all diagnoses.
    """
    flagged = any("all" in long.columns for long in longs.values())

    def flags(long: DataFrame) -> list[Column]:
        held = F.col("all") if "all" in long.columns else F.lit(True).alias("all")
        return [held, F.col("poa")] if flagged else [F.col("poa")]

    parts = [
        long.select(KEY, F.lit(system).alias("system"), F.col("category").cast("string").alias("category"), *flags(long))
        for system, long in longs.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def prevalence_all(longs: Mapping[str, DataFrame], cohort: DataFrame) -> DataFrame:
    """As :func:`prevalence`, one row per system and category, from one aggregation.

    ``n`` counts the rows of all diagnoses: those with the flag ``all``, where there is one.
    """
    total = cohort.agg(F.count_distinct(KEY)).scalar()
    rows = all_systems(longs)
    n = F.count(F.when(F.col("all"), True)) if "all" in rows.columns else F.count("*")
    counts = rows.groupBy("system", "category").agg(
        n.alias("n"), F.count(F.when(F.col("poa"), True)).alias("n_poa")
    )
    return counts.withColumns({"pct": 100.0 * F.col("n") / total, "pct_poa": 100.0 * F.col("n_poa") / total})


def poa_impact_all(prevalences: DataFrame, min_points: float = 0.1, k: int = 10) -> DataFrame:
    """As :func:`poa_impact`, the ``k`` largest drops of each system."""
    window = Window.partitionBy("system").orderBy(F.desc("delta_pct"), "category")
    return (
        prevalences.withColumn("delta_pct", F.col("pct") - F.col("pct_poa"))
        .where(F.col("delta_pct") > min_points)
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
    )


def poa_impact(prevalences: DataFrame, min_points: float = 0.1, k: int = 10) -> DataFrame:
    """Categories whose share drops most when evidence is asked for, in percentage points."""
    drop = F.col("pct") - F.col("pct_poa")
    return (
        prevalences.withColumn("delta_pct", drop)
        .where(F.col("delta_pct") > min_points)
        .orderBy(F.desc("delta_pct"), "category")
        .limit(k)
    )


def ccsr_features(long: DataFrame, cohort: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Both variants of every category as 0/1 columns, with the numbers of categories and body systems of each.

    One aggregation per encounter makes the bits; the counts are read off them, as a system has a category where
    one of its bits is set.
    """
    masks = long.groupBy(KEY).agg(*bit_masks(long, categories, {"all": F.lit(True), "poa": F.col("poa")}))
    wide = cohort.select(KEY).distinct().join(masks, KEY, "left")
    words = range((len(categories) + BITS - 1) // BITS)
    by_system: dict[str, dict[int, int]] = {}
    for i, c in enumerate(categories):
        word = by_system.setdefault(c[:3], {})
        word[i // BITS] = word.get(i // BITS, 0) | 1 << (i % BITS)

    def total(parts: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, parts, F.lit(0))

    flags, counts = [], []
    for variant in ("all", "poa"):
        mask = [F.coalesce(F.col(f"_{variant}{i}"), F.lit(0).cast("long")) for i in words]
        held = [
            reduce(lambda a, b: a | b, [mask[i].bitwiseAND(F.lit(bits)) != 0 for i, bits in parts.items()])
            for parts in by_system.values()
        ]
        flags += bit_flags(categories, f"ccsr_{variant}_", variant)
        counts += [
            total([F.bit_count(m) for m in mask]).cast("short").alias(f"ccsr_{variant}_count"),
            total([h.cast("int") for h in held]).cast("short").alias(f"ccsr_{variant}_sys_count"),
        ]
    return wide.select(KEY, *flags, *counts)


def ccsr_counts(long: DataFrame, cohort: DataFrame) -> DataFrame:
    """Number of categories and of body systems, for both variants."""
    system = F.left("category", F.lit(3))
    per_system = long.groupBy(KEY, system.alias("system")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("poa"), True)).alias("n_poa")
    )
    counts = per_system.groupBy(KEY).agg(
        F.sum("n").alias("ccsr_all_count"),
        F.sum("n_poa").alias("ccsr_poa_count"),
        F.count("*").alias("ccsr_all_sys_count"),
        F.count(F.when(F.col("n_poa") > 0, True)).alias("ccsr_poa_sys_count"),
    )
    filled = [
        F.coalesce(F.col(c), F.lit(0)).cast("short").alias(c)
        for c in ("ccsr_all_count", "ccsr_poa_count", "ccsr_all_sys_count", "ccsr_poa_sys_count")
    ]
    return cohort.select(KEY).distinct().join(counts, KEY, "left").select(KEY, *filled)


def ccsr_systems(
    long: DataFrame, cohort: DataFrame, names: Mapping[str, str] = fv.CCSR_SYSTEMS
) -> DataFrame:
    """Encounters per body system in both variants."""
    system = F.left("category", F.lit(3))
    total = cohort.agg(F.count_distinct(KEY)).scalar()
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    per_encounter = long.groupBy(KEY, system.alias("system")).agg(F.bool_or("poa").alias("poa"))
    return (
        per_encounter.groupBy("system")
        .agg(F.count("*").alias("n"), F.count(F.when(F.col("poa"), True)).alias("n_poa"))
        .select(
            "system",
            F.coalesce(F.element_at(table, F.col("system")), F.col("system")).alias("name"),
            "n", "n_poa", n_pct(F.col("n"), total, 4).alias("pct"),
        )
    )
