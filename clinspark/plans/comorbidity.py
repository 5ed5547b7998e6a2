"""Queries: mappings, Elixhauser, HCC and CCSR features.

The published mapping files are not part of the data, so small mappings over the codes of the views
stand in for them; the rules, prefixes and weights are the real ones.
"""

from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.operators import comorbidity as cm
from clinspark.operators import hcc as hc
from clinspark.plans.extraction import in_list, keys
from clinspark.plans.registry import query, shared
from clinspark.sources import mappings as mp
from clinspark.sources.tables import union_sites

# code -> categories
AHRQ = {
    "I509": ["HF"], "I426": ["HF", "ALCOHOL"], "J449": ["LUNG_CHRONIC"], "E1122": ["DIAB_CX"],
    "E119": ["DIAB_UNCX"], "N184": ["RENLFL_MOD"], "N179": ["RENLFL_SEV"], "C7800": ["CANCER_METS"],
    "K7460": ["LIVER_MLD"], "I10": ["HTN_UNCX"], "F315": ["PSYCHOSES", "DEPRESS"], "I330": ["VALVE"],
    "A419": ["CBVD_POA"], "R6521": ["CBVD_SQLA"], "L0390": ["PERIVASC"], "G030": ["NEURO_OTH"],
}
HCC = {
    "A419": [2], "R6521": [2], "I509": [226], "I426": [221, 227], "I10": [223], "J449": [280], "E1122": [37],
    "E119": [38], "N184": [327], "N179": [326], "C7800": [17, 18], "K7460": [64], "K650": [62, 68],
    "L0390": [63], "J189": [202, 282], "F315": [154], "M545": [238], "R509": [136, 213], "N390": [379, 409],
    "I330": [263], "G030": [190], "R570": [211],
}
CCSR = {
    "A419": ["INF002", "CIR013"], "R6521": ["INF002", "SYM011"], "J189": ["RSP002"], "N390": ["GEN004"],
    "K650": ["DIG015"], "L0390": ["SKN001"], "G030": ["NVS001"], "I330": ["CIR003", "INF003"], "R570": ["SYM012"],
    "N179": ["GEN002"], "R509": ["SYM002"], "Z8619": ["FAC013"], "I509": ["CIR019"], "J449": ["RSP008"],
    "E1122": ["END003", "GEN003"], "E119": ["END002"], "N184": ["GEN003"], "I426": ["CIR005", "MBD017"],
    "C7800": ["NEO070"], "K7460": ["DIG019"], "I10": ["CIR007"], "F315": ["MBD003"], "M545": ["MUS011"],
}
COEFFICIENTS = (
    {f"HCC{n}": round(0.05 + (n % 37) * 0.021, 3) for ns in HCC.values() for n in ns if n != 238}
    | {name: 0.05 * (i + 1) for i, name in enumerate(fv.HCC_INTERACTIONS)}
    | {f"D{i}": round(0.01 * i * i, 3) for i in range(3, 10)}
    | {"D10P": 1.5}
)


def pairs(mapping):
    return [(code, value) for code, values in mapping.items() for value in values]


def values_sql(rows, columns):
    def literal(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def mapping(w, rows, kind="string"):
    column = "hcc int" if kind == "int" else "category string"
    return w.spark.createDataFrame(rows, f"icd_code string, {column}")


def ahrq_map(w):
    return mapping(w, pairs(AHRQ))


def hcc_map(w):
    return mapping(w, pairs(HCC), "int")


def ccsr_map(w):
    return mapping(w, pairs(CCSR))


def coefficients(w):
    return w.spark.createDataFrame(list(COEFFICIENTS.items()), "feature string, coef double")


shared("ahrq_map", values_sql(pairs(AHRQ), "icd_code, category"))
shared("hcc_map", values_sql(pairs(HCC), "icd_code, hcc"))
shared("ccsr_map", values_sql(pairs(CCSR), "icd_code, category"))
shared("coefs", values_sql(list(COEFFICIENTS.items()), "feature, coef"))
shared("quan_map", values_sql(
    [(p, c, c not in fv.QUAN_POA_EXEMPT) for c, prefixes in fv.QUAN_CODES.items() for p in prefixes],
    "prefix, category, poa_dependent"))

# --- mapping tables -----------------------------------------------------------------------------------

MATRIX = ["cat_small", "cat_cheap", "cat_ring"]
shared("matrix_table", """
    SELECT 'P' || CAST(p_partkey AS STRING) AS code, CASE WHEN p_size < 10 THEN 1 ELSE 0 END AS cat_small,
           CASE WHEN p_retailprice < 950 THEN 1 END AS cat_cheap, CASE WHEN p_name LIKE '%ring' THEN 1 ELSE 0 END AS cat_ring
    FROM {part}""")
SIX = [f"category_{i}" for i in range(1, 7)]
shared("six_table", """
    SELECT '''P' || CAST(p_partkey % 500 AS STRING) || '''' AS code, '''' || p_brand || '''' AS category_1,
           CASE WHEN p_size % 2 = 0 THEN '''' || p_type || ' ''' ELSE ''' ''' END AS category_2,
           CASE WHEN p_size % 3 = 0 THEN p_type ELSE '' END AS category_3, ' ' AS category_4,
           CAST(NULL AS STRING) AS category_5, CASE WHEN p_size % 5 = 0 THEN 'X1' ELSE '''''' END AS category_6
    FROM {part}""")


@query("matrix_unpivot", "\nUNION ALL ".join(
    f"SELECT code AS icd_code, '{c}' AS category FROM {{matrix_table}} WHERE {c} = 1" for c in MATRIX))
def _(w):
    part = w["part"]
    wide = part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"),
        (F.col("p_size") < 10).cast("int").alias("cat_small"),
        F.when(F.col("p_retailprice") < 950, 1).alias("cat_cheap"),
        F.col("p_name").endswith("ring").cast("int").alias("cat_ring"),
    )
    return mp.matrix_to_long(wide, "code", MATRIX)


SIX_LONG = "\nUNION ALL ".join(f"SELECT code, {c} AS cell FROM {{six_table}}" for c in SIX)


@query("multi_category_unpivot", f"""
    SELECT DISTINCT trim(code, ''' ') AS icd_code, trim(cell, ''' ') AS category FROM ({SIX_LONG})
    WHERE trim(cell, ''' ') <> ''""")
def _(w):
    quote = F.lit("'")
    size, kind = F.col("p_size"), F.col("p_type")
    rows = w["part"].select(
        F.concat(F.lit("'P"), (F.col("p_partkey") % 500).cast("string"), quote).alias("code"),
        F.concat(quote, "p_brand", quote).alias("category_1"),
        F.when(size % 2 == 0, F.concat(quote, kind, F.lit(" '"))).otherwise("' '").alias("category_2"),
        F.when(size % 3 == 0, kind).otherwise("").alias("category_3"),
        F.lit(" ").alias("category_4"),
        F.lit(None).cast("string").alias("category_5"),
        F.when(size % 5 == 0, "X1").otherwise("''").alias("category_6"),
    )
    return mp.ccsr_mapping(rows, "code", SIX)


# --- code sets of two sites ------------------------------------------------------------------------------

shared("gcohort", """
    SELECT encounterkey FROM {keys} UNION SELECT -encounterkey - 1 FROM {keys} WHERE encounterkey % 3 = 0""")
shared("gdx", """
    SELECT 'site_a' AS source, encounterkey, diagnosiskey, presentonadmission, type FROM {dx}
    UNION ALL SELECT 'site_b', * FROM {dx_b}""")
shared("gterm", """
    SELECT 'site_a' AS source, diagnosiskey, value FROM {term} WHERE type = 'ICD-10-CM'
    UNION ALL SELECT 'site_b', diagnosiskey, value FROM {term_b} WHERE type = 'ICD-10-CM'""")
POA = "coalesce(lower(presentonadmission) = 'yes', false) OR type IN ('Medical History', 'Problem List')"


def codes_sql(code, on="d.diagnosiskey = t.diagnosiskey"):
    return f"""
    SELECT DISTINCT d.encounterkey, {code} AS icd_code, presentonadmission, type, {POA} AS poa_qualified
    FROM {{gdx}} d JOIN {{gcohort}} c ON d.encounterkey = c.encounterkey JOIN {{gterm}} t ON {on}"""


FULL = "trim(upper(replace(replace(value, '.', ''), ' ', '')))"
shared("codes_dots", codes_sql("replace(value, '.', '')"))
shared("codes_full", codes_sql(FULL))


def cohort(w):
    main = keys(w).select("encounterkey")
    other = main.where("encounterkey % 3 = 0").select((-F.col("encounterkey") - 1).alias("encounterkey"))
    return main.unionByName(other)


def sites(w):
    dx = union_sites({"site_a": w["dx"].drop("patientdurablekey", "diagnosisname", "startdatekeyvalue"), "site_b": w["dx_b"]})
    terms = union_sites({"site_a": w["term"].select("diagnosiskey", "type", "value"), "site_b": w["term_b"]})
    return dx, terms


def codes(w, spelling, **options):
    dx, terms = sites(w)
    return cm.dx_code_set(dx, terms, cohort(w), spelling, **options)


def codes_full(w):
    return codes(w, "full", distinct=False)


def facts(w):
    """Diagnosis facts of both sites by diagnosis key; the keys of the sites clash, as in the default code set."""
    return cm.dx_facts(sites(w)[0], cohort(w))


def terms(w, spelling):
    return cm.term_codes(sites(w)[1], spelling)


@query("dx_code_set", "SELECT * FROM {codes_dots}")
def _(w):
    return codes(w, "dots")


@query("dx_code_set_site_safe", codes_sql(
    "replace(value, '.', '')", "d.diagnosiskey = t.diagnosiskey AND d.source = t.source"))
def _(w):
    return codes(w, "dots", site="source")


@query("mapping_coverage", """
    SELECT count(*) FILTER (WHERE icd_code IN (SELECT icd_code FROM {hcc_map})) AS mapped, count(*) AS codes,
           round(100.0 * mapped / codes, 4) AS pct
    FROM (SELECT DISTINCT icd_code FROM {codes_full})""")
def _(w):
    return cm.mapping_coverage(codes_full(w), hcc_map(w))


# --- Elixhauser and CCSR ------------------------------------------------------------------------------------

shared("ahrq", f"""
    SELECT encounterkey, CASE WHEN category IN ('CBVD_POA', 'CBVD_SQLA') THEN 'CBVD' ELSE category END AS category,
           bool_or(category NOT IN {in_list(fv.AHRQ_POA_DEPENDENT)} OR poa_qualified) AS poa
    FROM {{codes_dots}} JOIN {{ahrq_map}} USING (icd_code) GROUP BY 1, 2""")
shared("quan", """
    SELECT encounterkey, category, bool_or(NOT poa_dependent OR poa_qualified) AS poa
    FROM {codes_dots} JOIN {quan_map} ON icd_code LIKE prefix || '%' GROUP BY 1, 2""")
shared("ccsr", """
    SELECT encounterkey, category, bool_or(poa_qualified) AS poa
    FROM {codes_full} JOIN {ccsr_map} USING (icd_code) GROUP BY 1, 2""")


def ahrq(w):
    return cm.ahrq_long(facts(w), ahrq_map(w), terms(w, "dots"))


def quan(w):
    return cm.quan_long(facts(w), codes=terms(w, "dots"))


def ccsr(w):
    return cm.ccsr_long(facts(w), ccsr_map(w), terms(w, "full"))


SYSTEMS = {"ahrq": ahrq, "quan": quan, "ccsr": ccsr}


def register_long(system, plan):
    @query(f"{system}_long", f"SELECT * FROM {{{system}}}")
    def _(w):
        return plan(w)

    @query(f"{system}_poa_long", f"SELECT encounterkey, category FROM {{{system}}} WHERE poa")
    def _(w):
        return cm.poa_only(plan(w))


for _system, _plan in SYSTEMS.items():
    register_long(_system, _plan)


def wide_sql(source, categories, prefix, where="true"):
    return ", ".join(
        f"coalesce(max(1) FILTER (WHERE category = '{c}' AND {where}), 0) AS {prefix}{c.lower()}" for c in categories
    )


QUAN = list(fv.QUAN_CODES)


@query("comorbidity_wide", f"""
    SELECT c.encounterkey, {wide_sql("quan", QUAN, "quan_all_")}
    FROM {{gcohort}} c LEFT JOIN {{quan}} q ON c.encounterkey = q.encounterkey GROUP BY c.encounterkey""")
def _(w):
    return cm.to_wide(quan(w), cohort(w), QUAN, "quan_all_")


shared("vw", values_sql(list(fv.VW_WEIGHTS_QUAN.items()), "category, weight"))
shared("vw_ahrq", values_sql(list(fv.VW_WEIGHTS_AHRQ.items()), "category, weight"))


@query("vw_score", """
    SELECT c.encounterkey, coalesce(sum(weight), 0)::BIGINT AS vw_score, count(weight) AS n_categories
    FROM {gcohort} c LEFT JOIN ({quan} q JOIN {vw} USING (category)) ON c.encounterkey = q.encounterkey
    GROUP BY c.encounterkey""")
def _(w):
    return cm.weighted_score(quan(w), cohort(w), fv.VW_WEIGHTS_QUAN)


def variant_sql(system, categories, weights, variant):
    prefix, where = f"{system}_{variant}_", "true" if variant == "all" else "poa"
    return f"""
        SELECT c.encounterkey, {wide_sql(system, categories, prefix, where)},
               coalesce(sum(weight) FILTER (WHERE {where}), 0)::BIGINT AS {prefix}vw_score,
               count(category) FILTER (WHERE {where}) AS {prefix}count
        FROM {{gcohort}} c LEFT JOIN ({{{system}}} q LEFT JOIN {{{weights}}} USING (category))
          ON c.encounterkey = q.encounterkey GROUP BY c.encounterkey"""


@query("elixhauser_features", "SELECT * FROM ({}) JOIN ({}) USING (encounterkey) JOIN ({}) USING (encounterkey) "
       "JOIN ({}) USING (encounterkey)".format(*[
           variant_sql(system, list(weights), table, variant)
           for system, weights, table in (("ahrq", fv.VW_WEIGHTS_AHRQ, "vw_ahrq"), ("quan", fv.VW_WEIGHTS_QUAN, "vw"))
           for variant in ("all", "poa")]))
def _(w):
    return cm.elixhauser_features(facts(w), cohort(w), ahrq_map(w), codes=terms(w, "dots"))


# prefixes of three lengths, and a category that has no weight
PREFIXES = [("I4261", "deep", True), ("E112", "mid", False), ("I426", "alcohol", False), ("J44", "cpd", True), ("K746", "unweighted", False)]
shared("prefix_map", values_sql(PREFIXES, "prefix, category, poa_dependent"))
shared("by_prefix", """
    SELECT encounterkey, category, bool_or(NOT poa_dependent OR poa_qualified) AS poa
    FROM (SELECT encounterkey, CASE WHEN icd_code = 'I426' AND encounterkey % 2 = 0 THEN 'I4261' ELSE icd_code END AS icd_code,
                 poa_qualified FROM {codes_dots})
    JOIN {prefix_map} ON icd_code LIKE prefix || '%' GROUP BY 1, 2""")


@query("quan_long_prefixes", "SELECT * FROM {by_prefix}")
def _(w):
    longer = F.when((F.col("icd_code") == "I426") & (F.col("encounterkey") % 2 == 0), "I4261").otherwise(F.col("icd_code"))
    table = w.spark.createDataFrame(PREFIXES, "prefix string, category string, poa_dependent boolean")
    return cm.quan_long(codes(w, "dots", distinct=False).withColumn("icd_code", longer), table, lengths=(3, 4, 5))


shared("prev", """
    SELECT category, count(*) AS n, count(*) FILTER (WHERE poa) AS n_poa,
           100.0 * n / (SELECT count(*) FROM {gcohort}) AS pct,
           100.0 * n_poa / (SELECT count(*) FROM {gcohort}) AS pct_poa
    FROM {quan} GROUP BY category""")


def rounded(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


@query("prevalence", "SELECT * REPLACE (round(pct, 6) AS pct, round(pct_poa, 6) AS pct_poa) FROM {prev}")
def _(w):
    return rounded(cm.prevalence(quan(w), cohort(w)), "pct", "pct_poa")


@query("any_category", """
    SELECT variant, n_any, round(100.0 * n_any / (SELECT count(*) FROM {gcohort}), 4) AS pct_any,
           round(s / (SELECT count(*) FROM {gcohort}), 6) AS mean_categories
    FROM (SELECT 'all' AS variant, count(DISTINCT encounterkey) AS n_any, count(*) AS s FROM {quan}
          UNION ALL SELECT 'poa', count(DISTINCT encounterkey), count(*) FROM {quan} WHERE poa)""")
def _(w):
    return rounded(cm.any_category(quan(w), cohort(w)), "mean_categories")


@query("poa_impact", """
    SELECT * REPLACE (round(pct, 6) AS pct, round(pct_poa, 6) AS pct_poa), round(pct - pct_poa, 6) AS delta_pct
    FROM {prev} WHERE pct - pct_poa > 0.1 ORDER BY pct - pct_poa DESC, category LIMIT 10""")
def _(w):
    return rounded(cm.poa_impact(cm.prevalence(quan(w), cohort(w))), "pct", "pct_poa", "delta_pct")


def all_sql(source):
    """Rows of several systems with a flag for each variant; ``in_all`` is true where a system's table does not have it."""
    held = {"hcc_rows": "in_all"}
    return " UNION ALL ".join(
        f"SELECT '{system}' AS system, encounterkey, category, {held.get(table, 'true')} AS in_all, poa FROM {{{table}}}" for system, table in source.items()
    )


shared("hcc_rows", """
    SELECT coalesce(a.encounterkey, p.encounterkey) AS encounterkey, 'HCC' || coalesce(a.h, p.h) AS category,
           a.h IS NOT NULL AS in_all, p.h IS NOT NULL AS poa
    FROM (SELECT encounterkey, unnest(hcc) AS h FROM {hcc_final}) a
    FULL JOIN (SELECT encounterkey, unnest(hcc) AS h FROM {hcc_final_poa}) p ON a.encounterkey = p.encounterkey AND a.h = p.h""")
shared("systems", all_sql({"ahrq": "ahrq", "quan": "quan", "hcc": "hcc_rows", "ccsr": "ccsr"}))
shared("prev_all", """
    SELECT system, category, count(*) FILTER (WHERE in_all) AS n, count(*) FILTER (WHERE poa) AS n_poa,
           100.0 * n / (SELECT count(*) FROM {gcohort}) AS pct,
           100.0 * n_poa / (SELECT count(*) FROM {gcohort}) AS pct_poa
    FROM {systems} GROUP BY system, category""")
PREVALENCE_SQL = "SELECT * REPLACE (round(pct, 6) AS pct, round(pct_poa, 6) AS pct_poa) FROM {prev_all}"
IMPACT_SQL = """
    SELECT * REPLACE (round(pct, 6) AS pct, round(pct_poa, 6) AS pct_poa, round(delta_pct, 6) AS delta_pct) FROM (
      SELECT *, pct - pct_poa AS delta_pct,
             row_number() OVER (PARTITION BY system ORDER BY pct - pct_poa DESC, category) AS rank
      FROM {prev_all} WHERE pct - pct_poa > 0.1) WHERE rank <= 10"""


def hcc_both(w):
    return hc.hcc_both(facts(w), hcc_map(w), coefficients(w), terms(w, "full"))


def four_systems(w):
    return {"ahrq": ahrq(w), "quan": quan(w), "hcc": hc.hcc_long(hcc_both(w)), "ccsr": ccsr(w)}


# the second name of each is that of an earlier version which alone counted both variants of HCC
@query("prevalence_all_variants", PREVALENCE_SQL)
@query("prevalence_all", PREVALENCE_SQL)
def _(w):
    return rounded(cm.prevalence_all(four_systems(w), cohort(w)), "pct", "pct_poa")


@query("poa_impact_all_variants", IMPACT_SQL)
@query("poa_impact_all", IMPACT_SQL)
def _(w):
    return rounded(cm.poa_impact_all(cm.prevalence_all(four_systems(w), cohort(w))), "pct", "pct_poa", "delta_pct")


@query("ccsr_counts", """
    SELECT c.encounterkey, count(category) AS ccsr_all_count, count(category) FILTER (WHERE poa) AS ccsr_poa_count,
           count(DISTINCT left(category, 3)) AS ccsr_all_sys_count,
           count(DISTINCT left(category, 3)) FILTER (WHERE poa) AS ccsr_poa_sys_count
    FROM {gcohort} c LEFT JOIN {ccsr} s ON c.encounterkey = s.encounterkey GROUP BY c.encounterkey""")
def _(w):
    return cm.ccsr_counts(ccsr(w), cohort(w))


CCSR_CATEGORIES = sorted({c for cs in CCSR.values() for c in cs})


@query("ccsr_wide", f"""
    SELECT c.encounterkey, {wide_sql("ccsr", CCSR_CATEGORIES, "ccsr_poa_", "poa")}
    FROM {{gcohort}} c LEFT JOIN {{ccsr}} q ON c.encounterkey = q.encounterkey GROUP BY c.encounterkey""")
def _(w):
    return cm.to_wide(cm.poa_only(ccsr(w)), cohort(w), CCSR_CATEGORIES, "ccsr_poa_")


@query("ccsr_features", f"""
    SELECT c.encounterkey, {wide_sql("ccsr", CCSR_CATEGORIES, "ccsr_all_")}, {wide_sql("ccsr", CCSR_CATEGORIES, "ccsr_poa_", "poa")},
           count(category) AS ccsr_all_count, count(category) FILTER (WHERE poa) AS ccsr_poa_count,
           count(DISTINCT left(category, 3)) AS ccsr_all_sys_count,
           count(DISTINCT left(category, 3)) FILTER (WHERE poa) AS ccsr_poa_sys_count
    FROM {{gcohort}} c LEFT JOIN {{ccsr}} q ON c.encounterkey = q.encounterkey GROUP BY c.encounterkey""")
def _(w):
    return cm.ccsr_features(ccsr(w), cohort(w), CCSR_CATEGORIES)


shared("system_names", values_sql(list(fv.CCSR_SYSTEMS.items()), "system, name"))


@query("ccsr_systems", """
    SELECT left(category, 3) AS system, any_value(name) AS name, count(DISTINCT encounterkey) AS n,
           count(DISTINCT encounterkey) FILTER (WHERE poa) AS n_poa,
           round(100.0 * count(DISTINCT encounterkey) / (SELECT count(*) FROM {gcohort}), 4) AS pct
    FROM {ccsr} JOIN {system_names} ON left(category, 3) = system GROUP BY 1""")
def _(w):
    return cm.ccsr_systems(ccsr(w), cohort(w))


# --- HCC -----------------------------------------------------------------------------------------------------


def any_of(names):
    return f"list_has_any(hcc, [{', '.join(str(n) for n in names)}])"


def cc_sql(where):
    return f"""
    SELECT encounterkey, list_sort(list(DISTINCT hcc)) AS cc FROM {{codes_full}} JOIN {{hcc_map}} USING (icd_code)
    WHERE {where} GROUP BY encounterkey"""


def patch_sql(source, key="encounterkey"):
    heart, others = fv.HCC_HEART_PATCH
    return f"""
    SELECT {key}, CASE WHEN list_contains(cc, {heart}) AND NOT list_has_any(cc, {others})
                            THEN list_filter(cc, lambda x: x <> {heart}) ELSE cc END AS hcc FROM {{{source}}}"""


def register_hierarchy(name, source, key="encounterkey"):
    """One shared step per rule, each reading the step before; the last one is ``name``."""
    step = source
    for i, (parent, children) in enumerate(fv.HCC_HIERARCHY):
        target = name if i == len(fv.HCC_HIERARCHY) - 1 else f"{name}_{i}"
        shared(target, f"""SELECT {key}, CASE WHEN list_contains(hcc, {parent}) THEN list_filter(hcc, lambda x: x NOT IN
            ({", ".join(map(str, children))})) ELSE hcc END AS hcc FROM {{{step}}}""")
        step = target


def score_sql(source):
    products = " UNION ALL ".join(
        f"SELECT encounterkey, '{name}' FROM {{{source}}} WHERE {any_of(fv.HCC_GROUPS[a])} AND {any_of(fv.HCC_GROUPS[b])}"
        for name, (a, b) in fv.HCC_INTERACTIONS.items()
    )
    return f"""
    SELECT s.encounterkey, list_sort(hcc) AS hcc, len(hcc) AS hcc_count, coalesce(raf, 0)::DOUBLE AS raf_score
    FROM {{{source}}} s LEFT JOIN (
      SELECT encounterkey, sum(coef::DECIMAL(12,6)) AS raf FROM (
        SELECT encounterkey, 'HCC' || unnest(hcc) AS feature FROM {{{source}}}
        UNION ALL {products}
        UNION ALL SELECT encounterkey, CASE WHEN len(hcc) >= 10 THEN 'D10P' ELSE 'D' || len(hcc) END FROM {{{source}}})
      JOIN {{coefs}} USING (feature) GROUP BY encounterkey) f ON s.encounterkey = f.encounterkey"""


shared("cc", cc_sql("true"))
shared("cc_poa", cc_sql("poa_qualified"))
shared("patched", patch_sql("cc"))
shared("patched_poa", patch_sql("cc_poa"))
register_hierarchy("hcc_final", "patched")
register_hierarchy("hcc_final_poa", "patched_poa")
shared("raf", score_sql("hcc_final"))
shared("raf_poa", score_sql("hcc_final_poa"))


def as_text(df, *names):
    """Arrays as text, so that results compare as plain values."""
    return df.select(*[F.concat_ws(",", F.sort_array(c)).alias(c) if c in names else F.col(c) for c in df.columns])


TEXT = "list_aggregate(list_sort({}), 'string_agg', ',')"


def hcc_sets(w, poa_only=False):
    return hc.hcc_sets(facts(w), hcc_map(w), poa_only=poa_only, codes=terms(w, "full"))


@query("hcc_cc_set", f"SELECT encounterkey, {TEXT.format('cc')} AS cc FROM {{cc}}")
def _(w):
    return as_text(hc.hcc_cc_set(facts(w), hcc_map(w), codes=terms(w, "full")), "cc")


@query("hcc_heart_patch", f"SELECT encounterkey, {TEXT.format('hcc')} AS hcc FROM {{patched}}")
def _(w):
    sets = hc.hcc_cc_set(facts(w), hcc_map(w), codes=terms(w, "full"))
    return as_text(sets.select("encounterkey", hc.heart_patch(F.col("cc")).alias("hcc")), "hcc")


@query("hcc_hierarchy", f"SELECT encounterkey, {TEXT.format('hcc')} AS hcc FROM {{hcc_final}}")
def _(w):
    return as_text(hcc_sets(w), "hcc")


def product_sql(pairs_):
    return ", ".join(
        f"CAST({any_of(fv.HCC_GROUPS[a])} AND {any_of(fv.HCC_GROUPS[b])} AS INT) AS {name}"
        for name, (a, b) in pairs_.items()
    )


@query("hcc_interactions", f"SELECT encounterkey, {product_sql(fv.HCC_INTERACTIONS)} FROM {{hcc_final}}")
def _(w):
    return hcc_sets(w).select("encounterkey", hc.interactions(F.col("hcc")).alias("i")).select("encounterkey", "i.*")


@query("hcc_dcount", """
    SELECT encounterkey, len(hcc) AS n, CASE WHEN len(hcc) >= 10 THEN 'D10P' WHEN len(hcc) > 0 THEN 'D' || len(hcc) END AS term
    FROM {hcc_final}""")
def _(w):
    return hcc_sets(w).select(
        "encounterkey", F.size("hcc").alias("n"), hc.dcount_key(F.size("hcc")).alias("term")
    )


def register_raf(name, source, poa_only):
    @query(name, f"SELECT * REPLACE ({TEXT.format('hcc')} AS hcc, round(raf_score, 6) AS raf_score) FROM {{{source}}}")
    def _(w):
        features = hc.hcc_features(facts(w), hcc_map(w), coefficients(w), poa_only, terms(w, "full"))
        return rounded(as_text(features, "hcc"), "raf_score")


register_raf("hcc_raf", "raf", False)
register_raf("hcc_raf_poa", "raf_poa", True)


@query("hcc_wide", "SELECT c.encounterkey, {}, round(coalesce(raf_score, 0), 4) AS hcc_all_raf_score, "
       "coalesce(hcc_count, 0) AS hcc_all_count FROM {{gcohort}} c LEFT JOIN {{raf}} r ON c.encounterkey = r.encounterkey".format(
           ", ".join(f"coalesce(list_contains(hcc, {n}), false)::INT AS hcc_all_hcc{n}" for n in fv.HCC_NUMBERS)))
def _(w):
    features = hc.hcc_features(facts(w), hcc_map(w), coefficients(w), codes=terms(w, "full"))
    wide = hc.hcc_wide(features, cohort(w))
    return wide.withColumn("hcc_all_raf_score", F.round(F.col("hcc_all_raf_score").cast("double"), 4))


def hcc_variant_sql(variant, source):
    held = ", ".join(f"coalesce(list_contains(hcc, {n}), false)::INT AS hcc_{variant}_hcc{n}" for n in fv.HCC_NUMBERS)
    return f"""SELECT c.encounterkey, {held}, round(coalesce(raf_score, 0), 4) AS hcc_{variant}_raf_score,
        coalesce(hcc_count, 0) AS hcc_{variant}_count FROM {{gcohort}} c LEFT JOIN {{{source}}} r ON c.encounterkey = r.encounterkey"""


@query("hcc_features_wide", f"SELECT * FROM ({hcc_variant_sql('all', 'raf')}) JOIN ({hcc_variant_sql('poa', 'raf_poa')}) USING (encounterkey)")
def _(w):
    wide = hc.hcc_features_wide(hcc_both(w), cohort(w))
    scores = {f"hcc_{v}_raf_score": F.round(F.col(f"hcc_{v}_raf_score").cast("double"), 4) for v in hc.VARIANTS}
    return wide.withColumns(scores)


def hcc_summary_sql(variant, source):
    return f"""SELECT '{variant}' AS variant, count(*) FILTER (WHERE hcc_count > 0) AS n_any, round(100.0 * n_any / count(*), 4) AS pct_any,
        round(avg(coalesce(hcc_count, 0)), 6) AS mean_count, round(avg(coalesce(raf_score, 0)), 6) AS mean_raf,
        round(quantile_cont(coalesce(raf_score, 0), 0.5), 6) AS median_raf
        FROM {{gcohort}} c LEFT JOIN {{{source}}} r ON c.encounterkey = r.encounterkey"""


@query("hcc_summary", f"{hcc_summary_sql('all', 'raf')} UNION ALL {hcc_summary_sql('poa', 'raf_poa')}")
def _(w):
    return rounded(hc.hcc_summary(hcc_both(w), cohort(w)), "mean_count", "mean_raf", "median_raf")


GROUPS = ", ".join(f"CAST({any_of(ns)} AS INT) AS {name}" for name, ns in fv.HCC_GROUPS.items())
DISABLED = ", ".join(
    f"CAST(disabl = 1 AND {any_of(fv.HCC_GROUPS[g])} AS INT) AS {name}" for name, g in fv.HCC_DISABLED_INTERACTIONS.items()
)
shared("demog", """
    SELECT *, CAST(age < 65 AND orec <> '0' AS INT) AS disabl,
           CAST(orec = '1' AND NOT (age < 65 AND orec <> '0') AS INT) AS origds
    FROM (SELECT *, greatest(0, CAST(floor(((year(DATE '2000-02-01') - year(birthdate)) * 12 + 2 - month(birthdate)
                      - CASE WHEN 1 < day(birthdate) THEN 1 ELSE 0 END) / 12) AS INT)) AS age FROM {person})""")


def persons(w):
    return hc.demographics(w["person"], F.lit("2000-02-01").cast("date"))


@query("hcc_groups", f"""
    SELECT s.encounterkey, {GROUPS}, {product_sql(fv.HCC_INTERACTIONS)},
           {product_sql(fv.HCC_DISABLED_COMMUNITY_INTERACTIONS)}, {DISABLED}
    FROM {{hcc_final}} s JOIN {{ed}} e ON s.encounterkey = e.encounterkey
    JOIN {{demog}} p ON e.patientdurablekey = p.patientdurablekey""")
def _(w):
    owners = w["ed"].select("encounterkey", "patientdurablekey")
    joined = hcc_sets(w).join(owners, "encounterkey").join(persons(w), "patientdurablekey")
    groups = hc.hcc_groups(F.col("hcc"), F.col("disabl"))
    return joined.select("encounterkey", groups.alias("g")).select("encounterkey", "g.*")


# every edited code, so that each diagnosis gets one of them
EDITED = [*fv.EDIT_FEMALE_CODES, *fv.EDIT_LUNG_CODES, *fv.EDIT_BREAST_CODES, *fv.EDIT_NEWBORN_CODES, "I10", "C7800"]
EDIT_MAP = pairs(HCC) + [("D66", 111), ("J410", 280), ("J439", 280), ("C50011", 23), ("C50919", 23), ("P0411", 190), ("P961", 190)]
shared("edit_map", values_sql(EDIT_MAP, "icd_code, hcc"))
shared("edit_dx", f"""
    SELECT o_custkey AS patientdurablekey, {EDITED}[CAST(l_partkey % {len(EDITED)} AS INT) + 1] AS icd_code,
           l_returnflag = 'A' AS poa_qualified
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""")
EDIT_OVERRIDE = f"""
    CASE WHEN sex = '2' AND icd_code IN {in_list(fv.EDIT_FEMALE_CODES)} THEN 112
         WHEN age < 18 AND icd_code IN {in_list(fv.EDIT_LUNG_CODES)} THEN -1
         WHEN age < 50 AND icd_code IN {in_list(fv.EDIT_BREAST_CODES)} THEN 22
         WHEN age >= 2 AND icd_code IN {in_list(fv.EDIT_NEWBORN_CODES)} THEN -1 END"""


def edit_facts(w):
    owners = w["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patientdurablekey"))
    return w["lineitem"].join(owners, "l_orderkey").select(
        "patientdurablekey", F.col("l_partkey").alias("diagnosiskey"), (F.col("l_returnflag") == "A").alias("poa_qualified")
    )


def edit_terms(w):
    table = F.array(*[F.lit(c) for c in EDITED])
    code = F.element_at(table, (F.col("p_partkey") % len(EDITED)).cast("int") + 1)
    return w["part"].select(F.col("p_partkey").alias("diagnosiskey"), code.alias("icd_code"))


@query("hcc_age_sex_edits", f"""
    SELECT patientdurablekey, {TEXT.format("list(DISTINCT cc)")} AS cc FROM (
      SELECT d.patientdurablekey, coalesce({EDIT_OVERRIDE}, hcc) AS cc
      FROM {{edit_dx}} d JOIN {{demog}} p ON d.patientdurablekey = p.patientdurablekey
      LEFT JOIN {{edit_map}} USING (icd_code)) WHERE cc <> -1 GROUP BY patientdurablekey""")
def _(w):
    key = "patientdurablekey"
    return as_text(hc.edited_cc_set(edit_facts(w), mapping(w, EDIT_MAP, "int"), persons(w), key, codes=edit_terms(w)), "cc")


# --- segment scores --------------------------------------------------------------------------------------------

CELLS = [f"{s}{c}" for s in "FM" for c, _ in fv.AGE_CELLS]
NEW_CELLS = [
    f"{m}_{o}_NE{s}{c}" for m in ("NMCAID", "MCAID") for o in ("NORIGDIS", "ORIGDIS") for s in "FM"
    for c, _ in fv.AGE_CELLS_NEW_ENROLLEE
]
CLINICAL = [f"HCC{n}" for n in sorted({n for ns in HCC.values() for n in ns})] + list(fv.HCC_INTERACTIONS)
CLINICAL += [f"D{i}" for i in range(1, 10)] + ["D10P"]
TERMS = {
    "community_aged": CELLS + CLINICAL + ["OriginallyDisabled_Female", "OriginallyDisabled_Male"],
    "community_disabled": CELLS + CLINICAL + list(fv.HCC_DISABLED_COMMUNITY_INTERACTIONS),
    "institutional": CELLS + CLINICAL + ["LTIMCAID", "ORIGDS", *fv.HCC_DISABLED_INTERACTIONS],
    "new_enrollee": NEW_CELLS,
}
SEGMENT_COEFFICIENTS = [
    (prefix, term, round(((i * 31 + j * 17) % 97) / 100, 2))
    for i, (prefix, model) in enumerate(fv.HCC_SEGMENTS.values()) for j, term in enumerate(TERMS[model])
]
shared("seg_coefs", values_sql(SEGMENT_COEFFICIENTS, "segment, feature, coef"))
shared("pcodes", f"""
    SELECT e.patientdurablekey, {FULL} AS icd_code FROM {{dx}} d JOIN {{ed}} e ON d.encounterkey = e.encounterkey
    JOIN {{term}} t ON d.diagnosiskey = t.diagnosiskey WHERE t.type = 'ICD-10-CM'""")
shared("pcc", """
    SELECT patientdurablekey, list_sort(list(DISTINCT hcc)) AS cc FROM {pcodes} JOIN {hcc_map} USING (icd_code)
    GROUP BY patientdurablekey""")
shared("ppatched", patch_sql("pcc", "patientdurablekey"))
register_hierarchy("pfinal", "ppatched", "patientdurablekey")
shared("phcc", """
    SELECT p.*, coalesce(hcc, []) AS hcc FROM {demog} p LEFT JOIN {pfinal} f ON p.patientdurablekey = f.patientdurablekey""")


def cell_sql(cells):
    cases = " ".join(f"WHEN age >= {start} THEN '{name}'" for name, start in reversed(cells))
    return f"(CASE WHEN sex = '2' THEN 'F' ELSE 'M' END || CASE {cases} END)"


CELL, NEW_CELL = cell_sql(fv.AGE_CELLS), cell_sql(fv.AGE_CELLS_NEW_ENROLLEE)
BOTH = "('community_aged'), ('community_disabled'), ('institutional')"


def terms_sql():
    parts = [
        f"SELECT patientdurablekey, model, 'HCC' || unnest(hcc) AS feature FROM {{phcc}}, (VALUES {BOTH}) AS m(model)",
        f"SELECT patientdurablekey, model, CASE WHEN len(hcc) >= 10 THEN 'D10P' ELSE 'D' || len(hcc) END FROM {{phcc}}, "
        f"(VALUES {BOTH}) AS m(model) WHERE len(hcc) > 0",
        f"SELECT patientdurablekey, 'community_aged', {CELL} FROM {{phcc}} WHERE age >= 65",
        f"SELECT patientdurablekey, 'community_disabled', {CELL} FROM {{phcc}} WHERE age < 65",
        f"SELECT patientdurablekey, 'institutional', {CELL} FROM {{phcc}}",
        "SELECT patientdurablekey, 'community_aged', 'OriginallyDisabled_Female' FROM {phcc} WHERE origds = 1 AND sex = '2'",
        "SELECT patientdurablekey, 'community_aged', 'OriginallyDisabled_Male' FROM {phcc} WHERE origds = 1 AND sex = '1'",
        "SELECT patientdurablekey, 'institutional', 'LTIMCAID' FROM {phcc} WHERE ltimcaid = 1",
        "SELECT patientdurablekey, 'institutional', 'ORIGDS' FROM {phcc} WHERE origds = 1",
        "SELECT patientdurablekey, 'new_enrollee', CASE WHEN nemcaid > 0 THEN 'MCAID' ELSE 'NMCAID' END || '_' || "
        f"CASE WHEN age >= 65 AND orec = '1' THEN 'ORIGDIS' ELSE 'NORIGDIS' END || '_NE' || {NEW_CELL} FROM {{phcc}}",
    ]
    for name, (a, b) in (fv.HCC_INTERACTIONS | fv.HCC_DISABLED_COMMUNITY_INTERACTIONS).items():
        models = ["community_aged", "community_disabled", "institutional"]
        if name in fv.HCC_DISABLED_COMMUNITY_INTERACTIONS:
            models = ["community_disabled"]
        if name == "HF_HCC238_V28":
            models = ["community_aged", "community_disabled"]
        for model in models:
            parts.append(
                f"SELECT patientdurablekey, '{model}', '{name}' FROM {{phcc}} "
                f"WHERE {any_of(fv.HCC_GROUPS[a])} AND {any_of(fv.HCC_GROUPS[b])}"
            )
    for name, group in fv.HCC_DISABLED_INTERACTIONS.items():
        parts.append(
            f"SELECT patientdurablekey, 'institutional', '{name}' FROM {{phcc}} WHERE disabl = 1 AND {any_of(fv.HCC_GROUPS[group])}"
        )
    return "\nUNION ALL ".join(parts)


shared("seg_terms", terms_sql())
shared("seg_names", values_sql([(p, m, s) for s, (p, m) in fv.HCC_SEGMENTS.items()], "segment, model, score"))
SCORES = ", ".join(
    f"round(coalesce(sum(coef::DECIMAL(12,6)) FILTER (WHERE score = '{s}'), 0)::DOUBLE * 1.045, 6) AS {s.lower()}"
    for s in fv.HCC_SEGMENTS
)


@query("hcc_segment_scores", f"""
    SELECT p.patientdurablekey, {SCORES}
    FROM {{person}} p LEFT JOIN (
      {{seg_terms}} t JOIN {{seg_names}} n USING (model) JOIN {{seg_coefs}} c USING (segment, feature))
      ON p.patientdurablekey = t.patientdurablekey GROUP BY p.patientdurablekey""")
def _(w):
    key = "patientdurablekey"
    owners = w["ed"].select("encounterkey", key)
    dx = w["dx"].drop(key).join(owners, "encounterkey")
    terms = w["term"].where("type = 'ICD-10-CM'").select(
        "diagnosiskey", F.trim(F.upper(F.translate("value", ". ", ""))).alias("icd_code")
    )
    sets = hc.hcc_sets(dx.join(terms, "diagnosiskey").select(key, "icd_code"), hcc_map(w), key)
    table = w.spark.createDataFrame(SEGMENT_COEFFICIENTS, "segment string, feature string, coef double")
    scores = hc.segment_scores(sets, persons(w), table, key, 1.045)
    return rounded(scores, *[s.lower() for s in fv.HCC_SEGMENTS])
