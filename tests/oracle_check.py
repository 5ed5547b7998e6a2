"""Run queries on Spark and their oracles on DuckDB and compare schema, row count and values.

    python tests/oracle_check.py [--sf 0.01] [name or prefix ...]
"""

import datetime
import decimal
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from clinspark.plans.adapter import BASE_TABLES  # noqa: E402

DATA = os.environ.get("CLINSPARK_TESTDATA", "/root/testdata")


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, (bool, np.bool_)):
        return ("bool", bool(value))
    if isinstance(value, (int, np.integer)):
        return ("num", round(float(value), 6))
    if isinstance(value, (float, np.floating, decimal.Decimal)):
        value = float(value)
        return None if math.isnan(value) else ("num", round(value, 6) + 0.0)
    if isinstance(value, (pd.Timestamp, datetime.datetime)):
        return ("time", pd.Timestamp(value).isoformat())
    if isinstance(value, datetime.date):
        return ("time", pd.Timestamp(value).isoformat())
    return ("text", str(value))


def table(pdf):
    columns = sorted(pdf.columns)
    rows = [tuple(plain(v) for v in row) for row in pdf[columns].itertuples(index=False, name=None)]
    return columns, sorted(rows, key=repr)


def compare(spark_df, oracle_df):
    """None when equal, else what differs."""
    left_columns, left = table(spark_df.astype(object))
    right_columns, right = table(oracle_df.astype(object))
    if left_columns != right_columns:
        return f"columns {left_columns} vs {right_columns}"
    if len(left) != len(right):
        extra = [r for r in left if r not in set(right)][:2], [r for r in right if r not in set(left)][:2]
        return f"rows {len(left)} vs {len(right)}; {extra}"
    diff = [(a, b) for a, b in zip(left, right) if a != b]
    if diff:
        return f"{len(diff)} of {len(left)} rows differ; columns {left_columns}; first {diff[:2]}"
    return None


def run(spark, names, sf):
    sf_dir = f"{DATA}/sf{sf}"
    con = oracle_connection(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            got = df.toPandas()
            spent = time.time() - start
            if name not in oracles:
                print(f"{name:32s} rows-only {len(got):8d}  {spent:5.1f}s", flush=True)
                continue
            problem = compare(got, con.execute(oracles[name]).df())
        except Exception as error:  # report and go on with the next query
            problem, spent, got = f"{type(error).__name__}: {str(error)[:700]}", time.time() - start, ()
        print(f"{name:32s} {'ok' if problem is None else 'BAD'} {len(got):8d}  {spent:5.1f}s", flush=True)
        if problem:
            bad.append(name)
            print("    " + problem[:1500], flush=True)
    return bad


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf = "0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf = args[at + 1]
        del args[at : at + 2]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in entry.queries() if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    started = time.time()
    bad = run(spark, names, sf)
    print(f"{len(names) - len(bad)} of {len(names)} agree in {time.time() - started:.0f}s; bad: {bad}")
    spark.stop()
    sys.exit(bool(bad))
