"""Site description and the Spark settings the operators count on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from clinspark import fixed_values as fv


@dataclass(frozen=True)
class SiteConfig:
    """One hospital site: where its tables are and which parts it has."""

    name: str
    path: str
    ed_department: str
    has_icu_registry: bool = True
    has_death_registry: bool = True
    has_social_determinants: bool = True
    lab_keys: dict[str, int] = field(default_factory=dict)
    assess_keys: dict[str, int] = field(default_factory=dict)
    resp_keys: dict[str, int] = field(default_factory=dict)


def site_a(path: str) -> SiteConfig:
    return SiteConfig(
        "site_a", path, fv.ED_DEPARTMENT_A,
        lab_keys=fv.LAB_KEYS_A, assess_keys=fv.ASSESS_KEYS_A, resp_keys=fv.RESP_KEYS_A,
    )


def site_b(path: str) -> SiteConfig:
    """The second site has no ICU registry, death registry or social determinants."""
    return SiteConfig(
        "site_b", path, fv.ED_DEPARTMENT_B, False, False, False,
        lab_keys=fv.LAB_KEYS_B, assess_keys=fv.ASSESS_KEYS_B, resp_keys=fv.RESP_KEYS_B,
    )


RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a single encounter or code may hold a large share of the rows: split such join partitions even
    # where the split costs one more exchange before the aggregation that follows
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # facts are much larger than the keys of a cohort: scans of facts take a Bloom filter of up to so many bytes of stored keys
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    # a union passes its parts' partitioning on when planned, yet adaptive execution may then join one part in another way, and
    # the join above fails on unequal numbers of partitions: the union of facts is dealt out anew
    "spark.sql.unionOutputPartitioning": "false",
    # a table is broadcast by the size of its files, which may be a hundredth of its rows in memory; the driver builds
    # the table to be broadcast, so what grows with the facts is dealt out instead
    "spark.sql.autoBroadcastJoinThreshold": "256KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "256KB",
    # a task sorts what it reads once or several times over: its share stays the same however large the tables are
    "spark.sql.files.maxPartitionBytes": "8MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
}
# bytes of table files for which one shuffle partition is set up at first; adaptive execution joins small ones
BYTES_PER_PARTITION = 1_000_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session; cluster size and memory stay with the session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def size_shuffles(spark: SparkSession, table_bytes: int) -> None:
    """Deal shuffles out to so many partitions that one stays small, whatever the size of the tables read."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", max(least, table_bytes // BYTES_PER_PARTITION)
    )
