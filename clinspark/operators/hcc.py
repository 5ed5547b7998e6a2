"""Hierarchical condition categories, risk scores and segment scores.

An encounter's categories are a small array (there are 115 in all), so the rules are array
expressions and the scores are sums over exploded feature names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.quantiles import numeric_profile
from clinspark.functions.scalars import age_completed, n_pct
from clinspark.operators.comorbidity import by_fact_key

KEY = "encounterkey"


def _ints(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def hcc_cc_set(
    dx: DataFrame, crosswalk: DataFrame, key: str = KEY, poa_only: bool = False, codes: DataFrame | None = None
) -> DataFrame:
    """The set of condition categories per encounter.

    ``dx`` holds codes, or facts whose codes are in ``codes`` (see :mod:`clinspark.operators.comorbidity`).
    """
    if poa_only:
        dx = dx.where("poa_qualified")
    keyed, on = by_fact_key(crosswalk, codes)
    return dx.join(keyed, on).groupBy(key).agg(F.sort_array(F.collect_set("hcc")).alias("cc"))


def hcc_cc_sets(dx: DataFrame, crosswalk: DataFrame, key: str = KEY, codes: DataFrame | None = None) -> DataFrame:
    """Both variants of the set in one row, ``cc`` and ``cc_poa``, from one aggregation."""
    keyed, on = by_fact_key(crosswalk, codes)
    qualified = F.when(F.col("poa_qualified"), F.col("hcc"))
    return dx.join(keyed, on).groupBy(key).agg(
        F.sort_array(F.collect_set("hcc")).alias("cc"), F.sort_array(F.collect_set(qualified)).alias("cc_poa")
    )


def heart_patch(cc: Column) -> Column:
    """The patched category goes when none of the other heart categories is there."""
    patched, others = fv.HCC_HEART_PATCH
    alone = F.array_contains(cc, patched) & ~F.arrays_overlap(cc, _ints(others))
    return F.when(alone, F.array_remove(cc, patched)).otherwise(cc)


def rule_table(rules: DataFrame) -> Column:
    """Hierarchy rules read from a file, ``(position, parent, children)``, as one array in their order.

    A scalar subquery, so nothing is collected while the plan is built; there are some sixty rules.  Add it as a column
    and give that to :func:`apply_hierarchy`.
    """
    rows = F.sort_array(F.collect_list(F.struct("position", F.col("parent").alias("p"), F.col("children").alias("c"))))
    return rules.agg(rows.alias("rules")).scalar()


def apply_hierarchy(cc: Column, rules: Sequence[tuple[int, Sequence[int]]] | Column = fv.HCC_HIERARCHY) -> Column:
    """Drop what each parent suppresses, rule by rule; a parent dropped earlier suppresses nothing.

    ``rules`` are pairs, or a column that holds the array of :func:`rule_table`.
    """
    if isinstance(rules, Column):
        table = rules
    else:
        table = F.array(*[F.struct(F.lit(p).alias("p"), _ints(c).alias("c")) for p, c in rules])

    def step(kept: Column, rule: Column) -> Column:
        return F.when(F.array_contains(kept, rule["p"]), F.array_except(kept, rule["c"])).otherwise(kept)

    # one category alone can suppress nothing
    return F.when(F.size(cc) > 1, F.aggregate(table, cc, step)).otherwise(cc)


def _group(hcc: Column, name: str) -> Column:
    return F.arrays_overlap(hcc, _ints(fv.HCC_GROUPS[name]))


def _as_flags(columns: dict[str, Column]) -> Column:
    return F.struct(*[flag.cast("int").alias(name) for name, flag in columns.items()])


def _products(hcc: Column, pairs: dict[str, tuple[str, str]]) -> dict[str, Column]:
    return {name: _group(hcc, a) & _group(hcc, b) for name, (a, b) in pairs.items()}


def interactions(hcc: Column) -> Column:
    """The five community interactions as a struct of 0/1."""
    return _as_flags(_products(hcc, fv.HCC_INTERACTIONS))


def hcc_groups(hcc: Column, disabled: Column | None = None) -> Column:
    """All diagnostic groups and interactions; those with disability where the flag is given."""
    flags = {name: _group(hcc, name) for name in fv.HCC_GROUPS}
    flags |= _products(hcc, fv.HCC_INTERACTIONS) | _products(hcc, fv.HCC_DISABLED_COMMUNITY_INTERACTIONS)
    if disabled is not None:
        flags |= {n: (disabled == 1) & _group(hcc, g) for n, g in fv.HCC_DISABLED_INTERACTIONS.items()}
    return _as_flags(flags)


def dcount_key(n: Column) -> Column:
    """Name of the count term: D1 to D9, D10P from ten on, none for zero."""
    return F.when(n >= 10, "D10P").when(n >= 1, F.concat(F.lit("D"), n.cast("string")))


def _named(flag: Column, name: str) -> Column:
    return F.when(flag, F.lit(name))


def _hcc_names(hcc: Column) -> Column:
    return F.transform(hcc, lambda h: F.concat(F.lit("HCC"), h.cast("string")))


def _features(hcc: Column, products: dict[str, Column]) -> Column:
    """Names of the terms that hold: categories, interactions and the count term."""
    terms = F.array(*[_named(flag, name) for name, flag in products.items()], dcount_key(F.size(hcc)))
    return F.array_compact(F.concat(_hcc_names(hcc), terms))


def hcc_sets(
    dx: DataFrame, crosswalk: DataFrame, key: str = KEY, poa_only: bool = False, codes: DataFrame | None = None
) -> DataFrame:
    """Categories after the heart patch and the hierarchy, one row per encounter with a category."""
    sets = hcc_cc_set(dx, crosswalk, key, poa_only, codes)
    return sets.select(key, apply_hierarchy(heart_patch(F.col("cc"))).alias("hcc"))


def _weights(coefficients: DataFrame, *columns: str) -> DataFrame:
    """Coefficients as exact numbers, broadcast: a model has few terms, and each may hold a large share of all persons, so that
    a join by term must not deal the terms of persons out."""
    return F.broadcast(coefficients.select(*columns, "feature", F.col("coef").cast("decimal(12,6)").alias("coef")))


def raf_score(sets: DataFrame, coefficients: DataFrame, key: str = KEY) -> DataFrame:
    """Sum of the coefficients of all terms that hold; a term without coefficient adds nothing."""
    hcc = F.col("hcc")
    terms = sets.select(key, F.explode(_features(hcc, _products(hcc, fv.HCC_INTERACTIONS))).alias("feature"))
    scores = terms.join(_weights(coefficients), "feature").groupBy(key).agg(F.sum("coef").alias("raf"))
    return sets.join(scores, key, "left").select(
        key, "hcc", F.size("hcc").alias("hcc_count"),
        F.coalesce(F.col("raf"), F.lit(0)).cast("double").alias("raf_score"),
    )


def hcc_features(
    dx: DataFrame, crosswalk: DataFrame, coefficients: DataFrame, poa_only: bool = False, codes: DataFrame | None = None
) -> DataFrame:
    return raf_score(hcc_sets(dx, crosswalk, poa_only=poa_only, codes=codes), coefficients)


VARIANTS = ("all", "poa")


def hcc_both(
    dx: DataFrame, crosswalk: DataFrame, coefficients: DataFrame, codes: DataFrame | None = None, key: str = KEY
) -> DataFrame:
    """Categories, count and score of both variants side by side, one row per encounter with a category.

    Columns are ``hcc_<variant>``, ``n_<variant>`` and ``raf_<variant>``.  The terms of both variants are scored by
    one join and one aggregation.
    """
    final = hcc_cc_sets(dx, crosswalk, key, codes).select(
        key, apply_hierarchy(heart_patch(F.col("cc"))).alias("hcc_all"),
        apply_hierarchy(heart_patch(F.col("cc_poa"))).alias("hcc_poa"),
    )
    named = [
        F.struct(F.lit(v).alias("variant"), _features(F.col(f"hcc_{v}"), _products(F.col(f"hcc_{v}"), fv.HCC_INTERACTIONS)).alias("f"))
        for v in VARIANTS
    ]
    terms = final.select(key, F.explode(F.array(*named)).alias("t")).select(key, "t.variant", F.explode("t.f").alias("feature"))
    sums = [F.sum(F.when(F.col("variant") == v, F.col("coef"))).alias(f"_{v}") for v in VARIANTS]
    scores = terms.join(_weights(coefficients), "feature").groupBy(key).agg(*sums)
    columns = []
    for v in VARIANTS:
        columns += [
            f"hcc_{v}", F.size(f"hcc_{v}").alias(f"n_{v}"),
            F.coalesce(F.col(f"_{v}"), F.lit(0)).cast("double").alias(f"raf_{v}"),
        ]
    return final.join(scores, key, "left").select(key, *columns)


def hcc_long(both: DataFrame) -> DataFrame:
    """Categories of both variants of :func:`hcc_both` in the long form, with a flag for each: ``all`` and ``poa``.

    One row per encounter and category that either variant keeps, also where the hierarchy leaves it in the
    present-on-admission variant alone.
    """
    return both.select(KEY, "hcc_all", "hcc_poa", F.explode(F.array_union("hcc_all", "hcc_poa")).alias("hcc")).select(
        KEY, F.concat(F.lit("HCC"), F.col("hcc").cast("string")).alias("category"),
        F.array_contains("hcc_all", F.col("hcc")).alias("all"), F.array_contains("hcc_poa", F.col("hcc")).alias("poa"),
    )


def hcc_features_wide(both: DataFrame, cohort: DataFrame, categories: Sequence[int] = fv.HCC_NUMBERS) -> DataFrame:
    """Both variants of every category as 0/1 columns, with count and score, for every encounter of the cohort."""
    columns = []
    for v in VARIANTS:
        held = F.col(f"hcc_{v}")
        columns += [
            F.coalesce(F.array_contains(held, c), F.lit(False)).cast("byte").alias(f"hcc_{v}_hcc{c}") for c in categories
        ]
        columns += [
            F.coalesce(f"raf_{v}", F.lit(0.0)).cast("float").alias(f"hcc_{v}_raf_score"),
            F.coalesce(f"n_{v}", F.lit(0)).cast("byte").alias(f"hcc_{v}_count"),
        ]
    return cohort.select(KEY).distinct().join(both, KEY, "left").select(KEY, *columns)


def hcc_summary(both: DataFrame, cohort: DataFrame) -> DataFrame:
    """Per variant: encounters with any category and their share, mean count, mean and median score of the cohort."""
    every = cohort.select(KEY).distinct().join(both, KEY, "left")
    rows = [
        F.struct(F.lit(v).alias("variant"), F.coalesce(f"n_{v}", F.lit(0)).alias("count"), F.coalesce(f"raf_{v}", F.lit(0.0)).alias("raf"))
        for v in VARIANTS
    ]
    long = every.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    sums = {"n_any": (F.col("count") > 0).cast("long"), "categories": F.col("count")}
    # every figure comes out of one count of the distinct scores
    profile = numeric_profile(long, ["variant"], "raf", {"median": 0.5}, sums=sums)
    return profile.select(
        "variant", "n_any", n_pct(F.col("n_any"), F.col("n"), 4).alias("pct_any"), (F.col("categories") / F.col("n")).alias("mean_count"),
        F.col("mean").alias("mean_raf"), F.col("median").alias("median_raf"),
    )


def hcc_wide(
    features: DataFrame,
    cohort: DataFrame,
    prefix: str = "hcc_all",
    categories: Sequence[int] = fv.HCC_NUMBERS,
) -> DataFrame:
    """One 0/1 column per category, the count and the score for every encounter of the cohort."""
    hcc = F.col("hcc")
    flags = [
        F.coalesce(F.array_contains(hcc, c), F.lit(False)).cast("byte").alias(f"{prefix}_hcc{c}")
        for c in categories
    ]
    return (
        cohort.select(KEY)
        .distinct()
        .join(features, KEY, "left")
        .select(
            KEY,
            *flags,
            F.coalesce("raf_score", F.lit(0.0)).cast("float").alias(f"{prefix}_raf_score"),
            F.coalesce("hcc_count", F.lit(0)).cast("byte").alias(f"{prefix}_count"),
        )
    )


# --- persons ----------------------------------------------------------------------------------------


def demographics(person: DataFrame, as_of: Column) -> DataFrame:
    """Age, disability and original entitlement of each person at a date.

    Disabled is under 65 with a non-zero entitlement code; originally disabled is entitled by
    disability and no longer counted as disabled.
    """
    age = age_completed(F.col("birthdate"), as_of)
    disabled = (F.col("age") < 65) & (F.col("orec") != "0")
    return (
        person.withColumn("age", age)
        .withColumn("disabl", disabled.cast("int"))
        .withColumn("origds", ((F.col("orec") == "1") & ~disabled).cast("int"))
    )


#: Edit classes: a bit for each list of codes that age or sex can change.
EDIT_CLASSES = {"female": 1, "lung": 2, "breast": 4, "newborn": 8}


def edited_crosswalk(crosswalk: DataFrame) -> DataFrame:
    """``(icd_code, hcc, edits)``: the crosswalk with the edit classes of each code as bits.

    Codes of a class that have no category are added with none, as an edit may give them one.
    """
    lists = {"female": fv.EDIT_FEMALE_CODES, "lung": fv.EDIT_LUNG_CODES, "breast": fv.EDIT_BREAST_CODES, "newborn": fv.EDIT_NEWBORN_CODES}
    bits: dict[str, int] = {}
    for name, codes in lists.items():
        for code in codes:
            bits[code] = bits.get(code, 0) | EDIT_CLASSES[name]
    classes = crosswalk.sparkSession.createDataFrame(list(bits.items()), "icd_code string, edits int")
    return crosswalk.select("icd_code", "hcc").join(classes, "icd_code", "full").select("icd_code", "hcc", F.coalesce("edits", F.lit(0)).alias("edits"))


def edited_category() -> Column:
    """The category of a diagnosis after the edits, null where they remove it; from ``hcc`` and ``edits`` of the code, and
    ``age`` in years and ``sex`` (1 male, 2 female) of the person."""

    def of(name: str) -> Column:
        return F.col("edits").bitwiseAND(F.lit(EDIT_CLASSES[name])) != 0

    none = F.lit(None).cast("int")
    return (
        F.when((F.col("sex") == "2") & of("female"), F.lit(fv.EDIT_FEMALE_CC))
        .when((F.col("age") < fv.EDIT_LUNG_UNDER_AGE) & of("lung"), none)
        .when((F.col("age") < fv.EDIT_BREAST_UNDER_AGE) & of("breast"), F.lit(fv.EDIT_BREAST_CC))
        .when((F.col("age") >= fv.EDIT_NEWBORN_FROM_AGE) & of("newborn"), none)
        .otherwise(F.col("hcc"))
    )


def edited_cc_set(
    dx: DataFrame, crosswalk: DataFrame, person: DataFrame, key: str, poa_only: bool = False, codes: DataFrame | None = None
) -> DataFrame:
    """As :func:`hcc_cc_set` by person, where age or sex changes or removes categories.

    The edit classes are put on the terminology, before any fact: a fact brings its category and classes along by diagnosis key, and what they
    mean for the person is decided after the join with ``person`` (``key``, ``age`` and ``sex``).  A person has a row
    if the edits leave a category.
    """
    if poa_only:
        dx = dx.where("poa_qualified")
    keyed, on = by_fact_key(edited_crosswalk(crosswalk), codes)
    # what a person has of one category and class is the same however often, so it is reduced before the person is joined
    held = dx.join(keyed, on).select(key, "hcc", "edits").distinct()
    decided = held.join(person.select(key, "age", "sex"), key).select(key, edited_category().alias("hcc"))
    return decided.where("hcc IS NOT NULL").groupBy(key).agg(F.sort_array(F.collect_set("hcc")).alias("cc"))


def _age_cell(cells: Sequence[tuple[str, int]], prefix: str = "") -> Column:
    """Name of the age and sex cell, such as F65_69."""
    label = reduce(
        lambda chain, cell: F.when(F.col("age") >= cell[1], cell[0]).otherwise(chain), cells, F.lit(None)
    )
    return F.concat(F.lit(prefix), F.when(F.col("sex") == "2", "F").otherwise("M"), label)


def segment_features(sets: DataFrame, person: DataFrame, key: str) -> DataFrame:
    """Terms that hold for a person under each model, as ``(key, model, feature)``.

    ``person`` is the result of :func:`demographics`; persons without a diagnosis have no category terms.
    """
    hcc = F.coalesce(F.col("hcc"), F.array().cast("array<int>"))
    community = _products(hcc, fv.HCC_INTERACTIONS)
    disabled_community = community | _products(hcc, fv.HCC_DISABLED_COMMUNITY_INTERACTIONS)
    institutional = {n: f for n, f in community.items() if n != "HF_HCC238_V28"} | {
        n: (F.col("disabl") == 1) & _group(hcc, g) for n, g in fv.HCC_DISABLED_INTERACTIONS.items()
    }
    cell = _age_cell(fv.AGE_CELLS)
    aged = F.col("age") >= 65
    originally = F.col("origds") == 1
    entitled = F.when(aged & (F.col("orec") == "1"), "ORIGDIS").otherwise("NORIGDIS")
    medicaid = F.when(F.col("nemcaid") > 0, "MCAID").otherwise("NMCAID")
    new_cell = _age_cell(fv.AGE_CELLS_NEW_ENROLLEE, "NE")
    demographic = {
        "community_aged": F.array(
            F.when(aged, cell),
            _named(originally & (F.col("sex") == "2"), "OriginallyDisabled_Female"),
            _named(originally & (F.col("sex") == "1"), "OriginallyDisabled_Male"),
        ),
        "community_disabled": F.array(F.when(~aged, cell)),
        "institutional": F.array(
            cell, _named(F.col("ltimcaid") == 1, "LTIMCAID"), _named(originally, "ORIGDS")
        ),
    }
    clinical = {
        "community_aged": community,
        "community_disabled": disabled_community,
        "institutional": institutional,
    }
    models = [
        F.struct(
            F.lit(model).alias("model"),
            F.array_compact(F.concat(demographic[model], _features(hcc, clinical[model]))).alias("features"),
        )
        for model in demographic
    ]
    models.append(
        F.struct(
            F.lit("new_enrollee").alias("model"),
            F.array(F.concat_ws("_", medicaid, entitled, new_cell)).alias("features"),
        )
    )
    return (
        person.join(sets, key, "left")
        .select(key, F.explode(F.array(*models)).alias("m"))
        .select(key, "m.model", F.explode("m.features").alias("feature"))
    )


def segment_scores(
    sets: DataFrame, person: DataFrame, coefficients: DataFrame, key: str, normalisation: float = 1.0
) -> DataFrame:
    """The nine scores of a person: sums of the coefficients of the terms in each segment's model.

    ``coefficients`` holds ``(segment, feature, coef)`` with the segment prefixes CNA to SNPNE.
    """
    spark = sets.sparkSession
    rows = [(segment, model, score) for score, (segment, model) in fv.HCC_SEGMENTS.items()]
    segments = F.broadcast(spark.createDataFrame(rows, "segment string, model string, score string"))
    weights = _weights(coefficients.join(segments, "segment"), "model", "score")
    names = list(fv.HCC_SEGMENTS)
    sums = (
        segment_features(sets, person, key)
        .join(weights, ["model", "feature"])
        .groupBy(key)
        .pivot("score", names)
        .agg(F.sum("coef"))
    )
    scaled = [
        (F.coalesce(F.col(n), F.lit(0)).cast("double") * normalisation).alias(n.lower()) for n in names
    ]
    return person.select(key).join(sums, key, "left").select(key, *scaled)
