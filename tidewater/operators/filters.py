"""Row filters with the null rules of SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import scratch_dir

_BRANCH = "tidewater_branch"


def filter_types(df: DataFrame, column: str, wanted: str | list[str]) -> DataFrame:
    """Rows whose ``column`` is one of the wanted values; a single value is accepted as it is."""
    return df.filter(F.col(column).isin([wanted] if isinstance(wanted, str) else list(wanted)))


def holds_or_unknown(condition: Column) -> Column:
    """A check in the sense of SQL: only FALSE fails, NULL passes. Never NULL itself."""
    return F.coalesce(condition, F.lit(True))


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the condition holds, all other rows): NULL counts as not held, so no row is lost."""
    holds = F.coalesce(condition, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def route(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """As ``split_by``, for rows that are costly to make: they are made once and written by branch, and each of the two results
    reads its branch alone.

    NULL counts as not held. Writing is one job, here and now; it follows the rows' own partitions, nothing is shuffled.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "route")
    df.withColumn(_BRANCH, F.coalesce(condition, F.lit(False))).write.partitionBy(_BRANCH).parquet(path)
    written = spark.read.schema(df.withColumn(_BRANCH, F.lit(True)).schema).parquet(path)
    return written.filter(F.col(_BRANCH)).drop(_BRANCH), written.filter(~F.col(_BRANCH)).drop(_BRANCH)


def lookup(df: DataFrame, **keys) -> DataFrame:
    """Rows at one (multi-level) label."""
    for name, value in keys.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def exists_flag(df: DataFrame, condition: Column, yes: str, no: str, name: str) -> DataFrame:
    """One row: ``yes`` when some row meets the condition, else ``no``."""
    return df.agg(F.when(F.count_if(condition) > 0, yes).otherwise(no).alias(name))
