"""Site tables, result files and the union of sites."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinspark.config import SiteConfig

# tables that are no patient data
SKIPPED_TABLES = ("encounterfact_0p1percent", "fmreportproperty")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on whichever file system it names."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under the path, on whichever file system it names."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def register_asset(
    spark: SparkSession, site: SiteConfig, skip: Iterable[str] = SKIPPED_TABLES
) -> list[str]:
    """Register each table directory of a site as a temporary view; return the names registered.

    A table that cannot be read, for whatever reason, is left out with a warning that names it, as one bad table must
    not stop the others.
    """
    fs, root = _file_system(spark, site.path)
    if not fs.exists(root):
        raise FileNotFoundError(site.path)
    skipped, registered = set(skip), []
    for status in sorted(fs.listStatus(root), key=lambda s: s.getPath().getName()):
        name = status.getPath().getName()
        if not status.isDirectory() or name in skipped:
            continue
        try:
            spark.read.parquet(status.getPath().toString()).createOrReplaceTempView(name)
        except Exception as error:  # a damaged file fails in other ways than a missing one
            warnings.warn(f"table {name} is left out: {type(error).__name__}: {str(error)[:300]}", stacklevel=2)
            continue
        registered.append(name)
    return registered


def load_optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table, or an empty frame of the schema where there is none."""
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


# text fields are quoted and quotes doubled; an empty text is written as "" and a missing one as nothing
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def read_csv_columns(
    spark: SparkSession, path: str, columns: Sequence[str], schema: StructType | str | None = None, line_breaks: bool = True
) -> DataFrame:
    """Some columns of a CSV file; the others are not parsed.

    Columns are text, or of the types in ``schema``, which describes the whole file.  Texts may hold line breaks and
    quotes; an empty text stays apart from a missing one.

    A file whose texts may hold line breaks can only be read from its beginning, by one task.  With ``line_breaks=False`` files
    are cut into splits and read by many tasks; if a text does hold a line break, the query fails.  That is told by a line
    with an odd number of quotes, which a second pass over the lines looks for, in as many tasks.
    """
    # the reader puts its null value in place of a field that holds nothing; an empty text must not equal it
    reader = spark.read.options(**CSV_OPTIONS | {"multiLine": line_breaks, "emptyValue": "", "nullValue": "\\N"})
    if schema is not None:
        reader = reader.schema(schema)
    if line_breaks:
        return reader.csv(path).select(*columns)
    quotes = F.regexp_count("value", F.lit(CSV_OPTIONS["quote"]))
    # one line is enough; a scalar subquery, so that it runs with the query and not before
    broken = spark.read.text(path).where(quotes % 2 == 1).limit(1).agg(F.count("*")).scalar()
    sound = F.when(broken == 0, True).otherwise(F.raise_error(F.lit(f"line break inside a text of {path}; read it with line_breaks=True")).cast("boolean"))
    return reader.csv(path).where(sound).select(*columns)


TYPED_FORMATS = ("parquet", "orc")


def write_result(
    df: DataFrame, directory: str, name: str, formats: Sequence[str] = ("parquet", "csv")
) -> None:
    """Write a result in each format under ``directory/name.<format>``.

    The result is computed once, into a typed format, and the others are copied from that; text is never a source.  Without
    a typed format among several, the result is computed for each.
    """
    target = f"{directory}/{name}"
    typed = [f for f in formats if f in TYPED_FORMATS]
    source = df
    for number, form in enumerate([*typed, *(f for f in formats if f not in TYPED_FORMATS)]):
        writer = source.write.mode("overwrite")
        if form == "csv":
            writer = writer.options(**CSV_OPTIONS)
        writer.format(form).save(f"{target}.{form}")
        if number == 0 and typed:
            source = df.sparkSession.read.schema(df.schema).format(form).load(f"{target}.{form}")


def publish_database(
    tables: Mapping[str, DataFrame | None], database: str, spark: SparkSession, location: str
) -> list[str]:
    """Save all tables of a site in one catalogue database kept under ``location``; tables the site lacks are left out."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    saved = []
    for name, df in tables.items():
        if df is not None:
            df.write.mode("overwrite").option("path", f"{location}/{name}").saveAsTable(f"`{database}`.`{name}`")
            saved.append(name)
    return saved


def write_json(df: DataFrame, path: str) -> None:
    """A one-row summary as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def union_sites(frames: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Rows of all sites with the site's name; a column that a site lacks is null there."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    whole = tagged[0]
    for df in tagged[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole
