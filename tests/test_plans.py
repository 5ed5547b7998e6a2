"""Plans of all registered queries, and results when one key holds a third of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from clinspark.config import configure
from clinspark.operators import cohort as co
from clinspark.operators import comorbidity as cm
from clinspark.operators import epochs as ep
from clinspark.operators import esofa as es
from clinspark.plans import load_all
from clinspark.plans import epochs as plans_epochs
from clinspark.plans import severity
from clinspark.plans.adapter import Warehouse
from clinspark.plans.registry import ORACLES, QUERIES
from clinspark.sources.tables import union_sites

load_all()
DATA = "/root/testdata/sf0.001"
FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "EvalPython", "InPandas", "MapInArrow"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(spark, DATA)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_no_nested_loops_and_no_python_in_any_plan(warehouse):
    bad = {}
    for name, build in QUERIES.items():
        plan = plan_of(build(warehouse))
        hits = [word for word in FORBIDDEN if word in plan]
        if hits:
            bad[name] = hits
    assert not bad


def test_item_filter_and_columns_reach_the_scan(spark, tmp_path, rows):
    wide = spark.range(100).select(
        F.col("id").alias("encounterkey"), (F.col("id") % 7).cast("int").alias("labcomponentkey"),
        F.lit("1").alias("value"), F.current_timestamp().cast("timestamp_ntz").alias("resultinstant"),
        F.lit("unused").alias("procedurename"),
    )
    wide.write.parquet(str(tmp_path / "labs"))
    plan = plan_of(co.wbc_events(spark.read.parquet(str(tmp_path / "labs"))))
    assert "In(labcomponentkey, [994,2810])" in plan.replace("2810,994", "994,2810")
    assert "procedurename" not in plan.split("ReadSchema")[1]


def test_flagship_shuffles_the_stacked_events_once(warehouse):
    """Joining with the arrival and aggregating per encounter share one exchange."""
    criteria = co.encounter_criteria(
        warehouse["lab"], warehouse["fs"], warehouse["img"], co.ed_arrival(warehouse["ed"])
    )
    above_the_events = plan_of(criteria).split("Union")[0]
    assert above_the_events.count("Exchange hashpartitioning(encounterkey") == 1


@pytest.fixture
def skewed(spark):
    """Events of which one encounter holds a third, and settings that make small partitions count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    n = 60_000
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    events = spark.range(n).repartition(8).select(
        key.alias("encounterkey"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 300).cast("int"), F.lit(0))).alias("takeninstant"),
        F.lit(32710).alias("flowsheetrowkey"),
        F.concat((60 + F.col("id") % 80).cast("string"), F.lit("/50")).alias("value"),
    )
    ed = spark.range(5000).select(F.col("id").alias("encounterkey"), start.alias("arrivalinstant"))
    yield events, ed
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_encounter_is_split_and_the_result_whole(spark, skewed):
    events, ed = skewed
    result = co.hypotension(events, co.ed_arrival(ed))
    got = {r["encounterkey"]: r["min_sbp"] for r in result.collect()}
    assert "skew=true" in plan_of(result)
    ids = [i for i in range(60_000) if i % 300 <= 240 and 60 + i % 80 < 90]
    want = {}
    for i in ids:
        k = 0 if i % 3 == 0 else i % 5000
        want[k] = min(want.get(k, 999), 60 + i % 80)
    assert got == {k: float(v) for k, v in want.items()}


def test_hot_encounter_in_epochs(spark, skewed):
    events, ed = skewed
    anchor = ed.withColumnRenamed("arrivalinstant", "inclusion_timestamp")
    measures = events.select("encounterkey", F.col("takeninstant").alias("ts"), F.lit("sbp").alias("label"), F.lit(1.0).alias("measure"))
    wide = ep.measure_epochs(measures, anchor, ["sbp"])
    assert wide.count() == events.select("encounterkey").distinct().count()
    assert wide.where("encounterkey = 0").first()["epoch_1_sbp"] == 1.0


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast, before the run-time planner changes them."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def shuffles(df):
    return [line for line in plan_of(df).splitlines() if re.search(r"\bExchange ", line)]


def made(df):
    """Exchanges without those that read one made before."""
    return [line for line in shuffles(df) if "ReusedExchange" not in line]


FACT_COLUMNS = "l_orderkey|encounterkey"
BY_CODE = ["ahrq_long", "quan_long", "ccsr_long", "hcc_cc_set", "hcc_raf", "elixhauser_features", "dx_flags", "hcc_age_sex_edits"]


@pytest.mark.parametrize("name", BY_CODE)
def test_facts_are_not_shuffled_by_code(no_broadcast, name):
    """What is exchanged by code has no encounter in it: it is the terminology and the mapping."""
    frame = QUERIES[name](Warehouse(no_broadcast, DATA))
    plan = frame._jdf.queryExecution().executedPlan()

    def walk(node):
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    hits = [
        node.simpleString(200)
        for node in walk(plan)
        if node.nodeName() == "Exchange" and re.search(r"hashpartitioning\(icd_(code|value)", node.simpleString(200))
        and re.search("encounterkey|patientdurablekey", node.output().mkString(","))
    ]
    assert not hits


def test_a_code_set_is_looked_up_by_prefix_in_one_pass(no_broadcast):
    """Its facts meet the terminology once and are not dealt out by code or prefix."""
    lines = made(QUERIES["quan_long_prefixes"](Warehouse(no_broadcast, DATA)))
    assert not [line for line in lines if re.search(r"hashpartitioning\((icd_code|prefix)", line)]
    assert sum("hashpartitioning(diagnosiskey" in line for line in lines) == 2


@pytest.mark.parametrize("name", ["hcc_raf", "hcc_raf_poa", "hcc_wide", "hcc_features_wide", "hcc_summary", "hcc_segment_scores"])
def test_scores_are_not_dealt_out_by_term(no_broadcast, name):
    """A term of the model may hold for most encounters, and all of it would be one task's."""
    frame = QUERIES[name](Warehouse(no_broadcast, DATA))
    assert not [line for line in shuffles(frame) if re.search(r"hashpartitioning\((model#\d+, )?feature", line)]


# exchanges of the heavy queries with broadcasting off; a rise means that an input is evaluated again
MOST_SHUFFLES = {"epoch_matrix": 60, "table1": 72, "elixhauser_features": 47, "prevalence_all": 71, "hcc_features_wide": 43, "ccsr_features": 40}
# those that the queries make themselves
MOST_MADE = {"hcc_summary": 40, "esofa": 30, "dataset_summary": 32}


@pytest.mark.parametrize("name", MOST_SHUFFLES)
def test_heavy_queries_shuffle_no_more_than_before(no_broadcast, name):
    assert len(shuffles(QUERIES[name](Warehouse(no_broadcast, DATA)))) <= MOST_SHUFFLES[name]


@pytest.mark.parametrize("name", MOST_MADE)
def test_inputs_are_evaluated_once(no_broadcast, name):
    assert len(made(QUERIES[name](Warehouse(no_broadcast, DATA)))) <= MOST_MADE[name]


def test_summary_is_one_count(no_broadcast):
    """Facts and keys meet in one aggregation; the keys are made once and the facts join nothing."""
    w = Warehouse(no_broadcast, DATA)
    plan = plan_of(QUERIES["dataset_summary"](w))
    assert plan.count("Exchange SinglePartition") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(kind", plan)) == 1
    own = plan.split("Union")[0]
    assert "Join" not in own


@pytest.mark.parametrize("name", ["missingness", "epoch_coverage"])
def test_counting_cells_needs_no_pivot(warehouse, name):
    assert "pivotfirst" not in plan_of(QUERIES[name](warehouse)).lower()


def test_counted_cells_equal_the_counted_matrix(warehouse):
    plain = {r["key"]: r["value"] for r in ep.missingness(plans_epochs.matrix(warehouse)).collect()}
    cells = {r["key"]: r["value"] for r in QUERIES["missingness"](warehouse).collect()}
    assert cells == pytest.approx(plain, abs=1e-9) and len(cells) == len(plans_epochs.matrix(warehouse).columns)
    for label in ("pulse", "map"):
        of_matrix = {r["covered"]: r["n"] for r in ep.epoch_coverage(plans_epochs.matrix(warehouse), label).collect()}
        of_measures = ep.label_coverage(plans_epochs.window(warehouse), ep.labelled_vitals(warehouse["vit"]), label)
        assert {r["covered"]: r["n"] for r in of_measures.collect()} == of_matrix


def test_one_code_on_a_third_of_the_facts(spark, skewed, rows):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000)
    dx = spark.range(n).repartition(8).select(
        (F.col("id") % 5000).alias("encounterkey"), key.alias("diagnosiskey"), (F.col("id") % 2 == 0).alias("poa_qualified")
    )
    codes = spark.range(2000).select(F.col("id").alias("diagnosiskey"), F.when(F.col("id") == 0, "I10").otherwise(F.concat(F.lit("E11"), (F.col("id") % 10).cast("string"))).alias("icd_code"))
    got = {(r["encounterkey"], r["category"]): r["poa"] for r in cm.quan_long(dx, codes=codes).collect()}
    want = {}
    for i in range(n):
        d = 0 if i % 3 == 0 else i % 2000
        code = "I10" if d == 0 else f"E11{d % 10}"
        category = "hypunc" if code == "I10" else "diabunc" if code[-1] in "019" else "diabc"
        want[i % 5000, category] = True
    assert got == want


def test_union_keeps_all_rows(rows):
    a = rows("k int", (1,), (1,))
    assert union_sites({"x": a, "y": a}).count() == 4


def test_a_stack_of_joined_facts_is_dealt_out_before_it_is_joined(no_broadcast, warehouse):
    """Its parts may be joined in other ways at run time, and then have other partitions than the plan says."""
    dealt = [events.repartition("encounterkey") for events in (*severity.organ_events(warehouse), warehouse["lab2"])]
    lines = plan_of(es.esofa(severity.window(warehouse), *dealt)).splitlines()
    union = next(i for i, line in enumerate(lines) if re.search(r"\bUnion\b", line))
    above = next(line for line in reversed(lines[:union]) if not re.search(r"\bProject\b", line))
    assert "Exchange hashpartitioning(encounterkey" in above


def test_a_small_file_of_many_rows_is_not_broadcast(spark, tmp_path):
    configure(spark)
    spark.range(300_000).withColumn("twice", F.col("id") * 2).coalesce(1).write.parquet(f"{tmp_path}/medications")
    medications = spark.read.parquet(f"{tmp_path}/medications")
    joined = spark.range(2_000_000).join(medications, "id")
    assert "Broadcast" not in plan_of(joined)
    assert joined.count() == 300_000
