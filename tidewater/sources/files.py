"""CSV, JSON and Parquet scans and sinks, and tables made from queries."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import nan_to_null


#: Files whose headers one job looks at.
HEADERS_AT_ONCE = 64


def csv_headers(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files under ``paths`` by their header, in order of path; empty files have none.

    One task per file, which stops reading after the first line: a limit does that, while a Python function is sent the whole
    file whatever it takes of it. The driver sees one line per file.
    """
    reader = spark.newSession()
    # a file is one split, and no task has a second one
    whole = str(1 << 40)
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        reader.conf.set(setting, whole)
    reader.conf.set("spark.sql.unionOutputPartitioning", "false")  # files side by side, not one after the other in a task
    files = [unquote(path) for path in sorted(reader.read.text(paths).inputFiles())]
    found: dict[tuple[str, ...], list[str]] = {}
    for at in range(0, len(files), HEADERS_AT_ONCE):
        some = files[at : at + HEADERS_AT_ONCE]
        heads = [reader.read.text(path).coalesce(1).limit(1).select(F.lit(i).alias("i"), "value") for i, path in enumerate(some)]
        for i, line in sorted(tuple(r) for r in reduce(DataFrame.unionAll, heads).collect()):
            names = next(csv.reader([line.removeprefix("\ufeff")]), [])
            found.setdefault(tuple(names), []).append(some[i])
    return found


def _column_names(header: tuple[str, ...]) -> list[str]:
    """Names as Spark's reader gives them: a missing one by its place, a repeated one with its place behind it."""
    lower = [n.lower() for n in header]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(header)]


def _read_by_headers(spark: SparkSession, headers: dict[tuple[str, ...], list[str]]) -> DataFrame:
    """Files of one header are one scan; scans are put together by name, and a name that a file lacks is NULL there."""
    scans = []
    for header, paths in headers.items():
        text = T.StructType([T.StructField(c, T.StringType()) for c in _column_names(header)])
        scans.append(spark.read.schema(text).option("header", True).csv(paths))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV files (a glob is fine), every column as text.

    Each file is read by its own header, so columns may stand in another order, be missing or be new in some of them; a name
    that differs in case only is the same column. Columns come in the order in which the files, by path, bring them up.
    """
    headers = csv_headers(spark, path)
    return _read_by_headers(spark, headers) if headers else spark.read.option("header", True).csv(path)


def _finite(value: Column, kind: T.DataType) -> Column:
    return nan_to_null(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def read_csv_options(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    null_values: tuple[str, ...] = ("",),
) -> DataFrame:
    """CSV with given names and types, any separator and several null markers.

    The reader takes one null marker only, so the text is read as it is, markers become NULL and
    the columns are cast afterwards in the same projection. The text ``NaN`` in a float column is missing, too.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("sep", sep).option("header", header).csv(path)
    return raw.select(
        *[
            _finite(F.when(~F.col(f.name).isin(*null_values), F.col(f.name)).cast(f.dataType), f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def source_tag(path: Column) -> Column:
    """yellow, green or fhv from a file's name; NULL for any other file."""
    name = F.lower(path)
    return (
        F.when(name.contains("yellow"), "yellow")
        .when(name.contains("green"), "green")
        .when(name.contains("for_hire_vehicle") | name.contains("fhv"), "fhv")
    )


def read_landing_tagged(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The feeds of a mixed landing folder by tag, each file read by its own header, with a column ``source_tag``.

    The tag comes from the file's name alone; other files are skipped.
    """
    # one row per file: names, not data
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("_metadata.file_name", "path")
    tagged = listed.withColumn("source_tag", source_tag(F.col("file_name"))).filter(F.col("source_tag").isNotNull())
    paths: dict[str, list[str]] = {}
    for tag, path in tagged.select("source_tag", "path").collect():
        paths.setdefault(tag, []).append(path)
    feeds = {}
    for tag, found in sorted(paths.items()):
        if headers := csv_headers(spark, found):
            feeds[tag] = _read_by_headers(spark, headers).withColumn("source_tag", F.lit(tag))
    return feeds


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), compression: str | None = None) -> None:
    """Overwrite ``path`` with Parquet, partitioned by columns when given; ``compression`` names another codec than the session's.

    Rows are first spread by partition value through a rebalance: each value is written by few tasks,
    and a value that holds much of the data is split over several instead of ending in one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").options(**({"compression": compression} if compression else {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Overwrite ``path`` with headered CSV; there is no index column."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def create_table_as(df: DataFrame, schema_name: str, table: str, location: str) -> str:
    """Create the schema below ``location`` when absent and save ``df`` as a table in it; returns the qualified name."""
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {schema_name} LOCATION '{location}'")
    name = f"{schema_name}.{table}"
    df.write.mode("overwrite").saveAsTable(name)
    return name
