"""Registry of queries: the Spark plan and, beside it, the DuckDB text it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinspark.config import configure
from clinspark.plans.adapter import BASE_TABLES, VIEWS, Warehouse, _DUCKDB, _render

QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHARED: dict[str, str] = {}


def shared(name: str, sql: str) -> None:
    """A named subquery that oracle texts may use as ``{name}``."""
    SHARED[name] = sql


def query(name: str, sql: str | None = None):
    """Register a plan under ``name`` with its oracle text."""

    def add(plan: Callable[[Warehouse], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return add


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[name](Warehouse(configure(spark), sf_dir))

    return run


def _placeholders(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def oracle_text(name: str) -> str:
    """One statement for DuckDB: the subqueries the oracle builds on, then its own text."""
    order: list[str] = []
    texts: dict[str, str] = {}

    def need(part: str) -> None:
        if part in texts or part in BASE_TABLES:
            return
        text = SHARED[part] if part in SHARED else _render(VIEWS[part], _DUCKDB)
        for inner in _placeholders(text):
            need(inner)
        texts[part] = text
        order.append(part)

    body = ORACLES[name]
    for part in _placeholders(body):
        need(part)

    def plain(text: str) -> str:
        return re.sub(r"\{(\w+)\}", r"\1", text)

    ctes = ",\n".join(f"{part} AS ({plain(texts[part])})" for part in order)
    return f"WITH {ctes}\n{plain(body)}" if ctes else plain(body)
