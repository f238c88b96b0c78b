"""Set operations and vertical concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides are made distinct first: copies are combined before the shuffle, not in the join."""
    return left.distinct().intersect(right.distinct())


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.distinct().subtract(right.distinct())


def union_all_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL with the name of the source in ``tag``."""
    return reduce(DataFrame.unionByName, [f.withColumn(tag, F.lit(name)) for name, f in frames.items()])


def concat_rows(frames: list[DataFrame], join: str = "outer") -> DataFrame:
    """``outer``: all columns, gaps NULL; ``inner``: the columns common to all frames."""
    if join == "outer":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    common = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    return reduce(DataFrame.unionByName, [f.select(*common) for f in frames])
