"""Python code of this library on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to the executors, once for each application; Spark sends it along like any ``--py-files``."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="clinspark-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def map_pandas(frame: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    ship(frame.sparkSession)
    return frame.mapInPandas(run, schema)


def map_arrow(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(frame.sparkSession)
    return frame.mapInArrow(run, schema)
