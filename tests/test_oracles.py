"""All registered queries against their DuckDB oracles."""

import pytest

import __spark_entry__ as entry
from oracle_check import DATA, compare, oracle_connection

from clinspark.plans.registry import ORACLES

NAMES = sorted(ORACLES)
SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_agrees(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert compare(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 643
