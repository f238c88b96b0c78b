"""Pivots with totals, unstack and stack.

The values that become columns are always given or read from one distinct job; cells are aggregated by
(row key, column key) with partial aggregation, so a frequent key does not load one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FUNCTIONS = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "mean": F.avg}


def pivot_values(df: DataFrame, column: str) -> list:
    """Distinct non-NULL values of the future columns, sorted. They become a schema, so more of them than the session's
    ``spark.sql.pivotMaxValues`` are an error; no more than one beyond that is fetched."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    values = df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values, too many to become columns")
    return sorted(r[0] for r in values)


def pivot(df: DataFrame, index: list[str], columns: str, values: str, function: str, names: list | None = None) -> DataFrame:
    """Rows x columns aggregate; an empty cell is NULL."""
    names = names if names is not None else pivot_values(df, columns)
    rows = df.dropna(subset=[*index, columns])
    return rows.groupBy(*index).pivot(columns, names).agg(FUNCTIONS[function](values))


def pivot_margins(
    df: DataFrame,
    index: list[str],
    columns: str,
    values: str,
    function: str,
    names: list | None = None,
    margin: str = "All",
) -> DataFrame:
    """Pivot with a totals row and column computed from the raw rows.

    ``is_total`` marks the totals row, so a real key spelled like the margin stays apart from it.
    """
    names = names if names is not None else pivot_values(df, columns)
    if margin in [str(n) for n in names]:
        raise ValueError(f"a column value is spelled {margin!r}; choose another margin name")
    rows = df.dropna(subset=[*index, columns])
    keys = [*index, columns]
    sets = [keys, index, [columns], []]
    cells = rows.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        F.grouping(index[0]).alias("__row_total"),
        F.grouping(columns).alias("__col_total"),
        FUNCTIONS[function](values).alias("__value"),
    )
    labels = [
        F.when(F.col("__row_total") == 1, F.lit(margin if i == 0 else "")).otherwise(F.col(c).cast("string")).alias(c)
        for i, c in enumerate(index)
    ]
    per_column = [
        F.max(F.when((F.col("__col_total") == 0) & (F.col(columns) == F.lit(n)), F.col("__value"))).alias(str(n))
        for n in names
    ]
    total = F.max(F.when(F.col("__col_total") == 1, F.col("__value"))).alias(margin)
    return (
        cells.select(*labels, F.col(columns), "__row_total", "__col_total", "__value")
        .groupBy(*index, "__row_total")
        .agg(*per_column, total)
        .withColumn("is_total", F.col("__row_total") == 1)
        .drop("__row_total")
    )


def row_mean(columns: list[str]) -> Column:
    """Mean of the non-NULL cells of a row."""
    present = F.filter(F.array(*[F.col(f"`{c}`").cast("double") for c in columns]), lambda v: v.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda a, v: a + v)
    return F.when(F.size(present) > 0, total / F.size(present))


def pivot_max_mean_margins(
    df: DataFrame, index: str, columns: str, values: str, names: list | None = None, margin: str = "All_mean"
) -> DataFrame:
    """Cells are maxima, margins are means of the cells; the corner is the mean of the row means."""
    names = names if names is not None else pivot_values(df, columns)
    cells = pivot(df, [index], columns, values, "max", names)
    cell_names = [str(n) for n in names]
    body = cells.select(
        F.col(index).cast("string").alias(index),
        *[F.col(f"`{c}`").cast("double").alias(c) for c in cell_names],
        row_mean(cell_names).alias(margin),
    )
    footer = body.agg(*[F.avg(f"`{c}`").alias(c) for c in [*cell_names, margin]]).select(
        F.lit(margin).alias(index), *cell_names, margin
    )
    return body.withColumn("is_total", F.lit(False)).unionByName(footer.withColumn("is_total", F.lit(True)))


def unstack(df: DataFrame, index: list[str], level: str, measures: list[str], names: list | None = None) -> DataFrame:
    """A key level becomes columns ``<measure>_<value>``; each (index, level) pair must be one row."""
    names = names if names is not None else pivot_values(df, level)
    cells = [
        F.max(F.when(F.col(level) == F.lit(n), F.col(m))).alias(f"{m}_{n}") for m in measures for n in names
    ]
    return df.groupBy(*index).agg(*cells)


def stack(df: DataFrame, ids: list[str], values: list[str], label: str, value: str) -> DataFrame:
    """Columns back to rows; NULL cells are dropped."""
    return df.unpivot(ids, values, label, value).filter(F.col(value).isNotNull())


def transpose_report(df: DataFrame, label: str) -> DataFrame:
    """Rows <-> columns of an aggregated report; the labels become column names."""
    return df.transpose(F.col(label))
