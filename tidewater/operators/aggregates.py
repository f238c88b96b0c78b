"""Grouped and whole-table aggregates. Each is one pass with partial aggregation before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import nan_to_null
from tidewater.operators.quantiles import QUANTILE_BOUND, aggregate_with_quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


class GroupTooLargeError(ValueError):
    """A result cell would hold more than the caller allowed."""


def numeric_columns(df: DataFrame, without: list[str] | None = None) -> list[str]:
    skipped = set(without or [])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skipped]


def without_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN in the float columns among ``columns`` as NULL."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns({c: nan_to_null(F.col(c)) for c in columns if c in floats})


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency of non-NULL values, most frequent first, ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), column)


def string_agg_ordered(
    df: DataFrame, keys: list[str], column: str, order_by: str, sep: str = ", ", name: str = "joined",
    max_chars: int | None = None,
) -> DataFrame:
    """Ordered concatenation per group.

    A group becomes one string in one row by definition. With ``max_chars`` the lengths are checked first, and a
    longer group is an error; nothing is cut.
    """
    if max_chars is not None:
        sizes = df.groupBy(*keys).agg(F.sum(F.length(column) + len(sep)).alias("chars"))
        if (longest := sizes.agg(F.max("chars")).first()[0] or 0) > max_chars:
            raise GroupTooLargeError(f"a group would need {longest} characters, {max_chars} are allowed")

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    literal = "'" + sep.replace("\\", "\\\\").replace("'", "\\'") + "'"
    joined = F.expr(f"listagg({quoted(column)}, {literal}) WITHIN GROUP (ORDER BY {quoted(order_by)})")
    return df.groupBy(*keys).agg(joined.alias(name))


def profile_relation(df: DataFrame, name: str) -> DataFrame:
    """One row: relation, degree, cardinality, formal notation, and non-NULL values per column."""
    return df.agg(
        F.lit(name).alias("relation"),
        F.lit(len(df.columns)).alias("degree"),
        F.count("*").alias("cardinality"),
        F.lit(f"{name}({', '.join(df.columns)})").alias("notation"),
        *[F.count(c).alias(f"{c}_non_null") for c in df.columns],
    )


def column_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean, sample deviation and sample variance of each numeric column, in one pass; NaN is a missing value."""
    names, parts = columns or numeric_columns(df), []
    for c in names:
        parts += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"), F.var_samp(c).alias(f"{c}_var")]
    return without_nan(df, names).agg(*parts)


def describe(
    df: DataFrame, columns: list[str], keys: list[str] | None = None, group_bound: int = QUANTILE_BOUND
) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, overall or per non-NULL group; quartiles are exact.

    NaN is a missing value in all of them.
    """
    keys = keys or []
    rows = without_nan(df.dropna(subset=keys) if keys else df, columns)
    parts = []
    for c in columns:
        parts += [
            F.count(c).alias(f"{c}_count"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
        ]
    return aggregate_with_quantiles(rows, parts, columns, QUARTILES, keys, group_bound=group_bound)


def group_agg(
    df: DataFrame, keys: list[str], functions: dict[str, list[str]], group_bound: int = QUANTILE_BOUND
) -> DataFrame:
    """Functions per column by a dict, flat names ``<column>_<function>``; medians are exact. NULL groups are left out."""
    built_in = {"min": F.min, "max": F.max, "mean": F.avg, "sum": F.sum, "count": F.count, "std": F.stddev_samp}
    rows = without_nan(df.dropna(subset=keys), list(functions))
    parts = [
        built_in[f](c).alias(f"{c}_{f}") for c, names in functions.items() for f in names if f != "median"
    ]
    medians = [c for c, names in functions.items() if "median" in names]
    if medians:
        return aggregate_with_quantiles(rows, parts, medians, {"median": 0.5}, keys, group_bound=group_bound)
    return rows.groupBy(*keys).agg(*parts)


def group_means(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Mean of every numeric column per non-NULL group; NaN is a missing value."""
    names = columns or numeric_columns(df, keys)
    return without_nan(df, names).dropna(subset=keys).groupBy(*keys).agg(*[F.avg(c).alias(f"{c}_mean") for c in names])
