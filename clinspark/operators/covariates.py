"""Ranking recorded variables by clinical concept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinspark import fixed_values as fv

DATA_TYPES = ["Laboratory", "Vital Signs", "Respiratory"]


def covariate_raw_stats(events: DataFrame, name: str, data_type: str, site: str) -> DataFrame:
    """Records and distinct encounters per raw variable name."""
    return (
        events.where(F.col(name).isNotNull())
        .groupBy(F.col(name).alias("raw_name"))
        .agg(F.count("*").alias("records"), F.count_distinct("encounterkey").alias("encounters"))
        .select("raw_name", F.lit(data_type).alias("data_type"), F.lit(site).alias("site"), "records", "encounters")
    )


def site_raw_stats(
    site: str, labs: DataFrame | None, assess: DataFrame | None, resp: DataFrame | None
) -> DataFrame:
    """Statistics of the three event tables of a site; a table the site lacks is left out."""
    sources = [(labs, "componentname"), (assess, "flowsheetrowname"), (resp, "flowsheetrowname")]
    parts = [
        covariate_raw_stats(events, name, data_type, site)
        for (events, name), data_type in zip(sources, DATA_TYPES)
        if events is not None
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def map_concepts(stats: DataFrame, concepts: Mapping[str, Sequence[str]] = fv.CONCEPTS) -> DataFrame:
    """Add the clinical concept of a raw name; a name without concept is its own."""
    rows = [(raw, concept) for concept, names in concepts.items() for raw in names]
    table = stats.sparkSession.createDataFrame(rows, "raw_name string, concept string")
    joined = stats.join(table, "raw_name", "left")
    return joined.withColumn("concept", F.coalesce("concept", "raw_name"))


def covariate_table(stats: DataFrame, sites: Sequence[str]) -> DataFrame:
    """One row per concept with records, encounters and names of every site and the totals.

    Encounters are added up over raw names, so an encounter with two of them counts twice.
    """
    columns, totals = [], []
    for site in sites:
        here = F.col("site") == site
        columns += [
            F.array_join(F.array_sort(F.collect_set(F.when(here, F.col("raw_name")))), "; ").alias(f"{site}_names"),
            F.sum(F.when(here, F.col("records")).otherwise(0)).alias(f"{site}_records"),
            F.sum(F.when(here, F.col("encounters")).otherwise(0)).alias(f"{site}_encounters"),
        ]
        totals.append(site)
    # the first type in the order of sites and tables
    position = F.struct(
        F.array_position(F.array(*[F.lit(s) for s in sites]), F.col("site")).alias("s"),
        F.array_position(F.array(*[F.lit(t) for t in DATA_TYPES]), F.col("data_type")).alias("t"),
        F.col("data_type").alias("name"),
    )
    return (
        map_concepts(stats)
        .groupBy("concept")
        .agg(
            F.min(position)["name"].alias("data_type"),
            *columns,
            F.sum("records").alias("total_records"),
            F.sum("encounters").alias("total_encounters"),
        )
        .orderBy(F.desc("total_records"), "concept")
    )


def covariate_top_n(table: DataFrame, n: int = 50) -> DataFrame:
    """The concepts with most records and their rank, numbered after the limit."""
    order = [F.desc("total_records"), "concept"]
    top = table.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
