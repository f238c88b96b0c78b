"""Projections, renames and schema conformity: each is one ``select`` over its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_by_map(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames the columns that exist; the names are compared with case, as the feeds differ by it."""
    present = {old: new for old, new in names.items() if old in df.columns}
    return df.select(*[F.col(f"`{c}`").alias(present.get(c, c)) for c in df.columns])


def add_missing_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Absent columns as typed NULL."""
    absent = [F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in df.columns]
    return df.select("*", *absent)


def sort_columns_by_name(df: DataFrame, descending: bool = False) -> DataFrame:
    return df.select(*sorted(df.columns, reverse=descending))


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts by a dict of types; a value that does not fit fails the query."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def cast_with_rejects(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows with the columns cast, values that do not fit as NULL; per column how many were present but did not fit)."""
    cast = df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    lost = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c) for c, kind in types.items()]
    return cast, df.agg(*lost).unpivot([], list(types), "column_name", "n_rejected")


def apply_per_column(df: DataFrame, functions: dict[str, object]) -> DataFrame:
    """A different expression for each named column; a function may be a Column -> Column callable."""
    replaced: list[Column] = []
    for c in df.columns:
        replaced.append(functions[c](F.col(c)).alias(c) if c in functions else F.col(c))
    return df.select(*replaced)
