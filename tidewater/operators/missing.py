"""Missing values and cell updates. None of these shuffles the data; counts are one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_mask(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).isNull().alias(c) for c in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    """One row: NULLs per column and ``total_nulls``."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    total = F.lit(0).cast("long")
    for c in df.columns:
        total = total + F.count_if(F.col(c).isNull())
    return df.agg(*counts, total.alias("total_nulls"))


def drop_rows_with_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=columns)


def drop_columns_with_null(df: DataFrame) -> DataFrame:
    """Drops each column that holds a NULL: one counting job decides the schema."""
    counts = null_counts(df).first().asDict()
    return df.drop(*[c for c in df.columns if counts[c] > 0])


def fill_scalar(df: DataFrame, value) -> DataFrame:
    return df.fillna(value)


def fill_by_column(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def update_cells(df: DataFrame, condition: Column, values: dict) -> DataFrame:
    """New frame with ``values`` set where the condition holds; NULL conditions change nothing."""
    return df.select(
        *[
            F.when(condition, F.lit(values[c])).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in values
            else F.col(c)
            for c in df.columns
        ]
    )
