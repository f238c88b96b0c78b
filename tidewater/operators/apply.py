"""User functions over rows and groups, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import split_literal
from tidewater.operators.aggregates import GroupTooLargeError
from tidewater.operators.ordering import largest_group


def row_apply(df: DataFrame, function: Callable[[pd.DataFrame], pd.Series], name: str, type_name: str) -> DataFrame:
    """A vectorised row function: it sees a batch of rows and returns one value per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{name: function(pdf)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{fields}, `{name}` {type_name}")


def group_apply_rowwise(df: DataFrame, key: str, functions: dict[object, Callable[[pd.DataFrame], pd.DataFrame]]) -> DataFrame:
    """A function per group label for functions that treat each row by itself.

    Such a function gives the same result on any slice of its group, so the rows are not shuffled and no
    group has to fit into a task. Labels without a function pass unchanged.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pieces = [
                functions[label](piece.copy()) if label in functions else piece
                for label, piece in pdf.groupby(key, sort=False, dropna=False)
            ]
            yield pd.concat(pieces) if pieces else pdf

    return df.mapInPandas(run, df.schema)


def group_apply(
    df: DataFrame, keys: list[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
    group_bound: int | None = None,
) -> DataFrame:
    """A function that needs its whole group at once: a group is one task by definition.

    With ``group_bound`` the groups are counted first, and a larger one is an error; nothing is cut.
    """
    if group_bound is not None and (size := largest_group(df, keys)) > group_bound:
        raise GroupTooLargeError(f"the largest group has {size} rows, {group_bound} are allowed")
    return df.groupBy(*keys).applyInPandas(function, schema)


def word_rows(df: DataFrame, key: str, text: str, sep: str = " ") -> DataFrame:
    """Words to rows, key kept; ``sep`` is literal text."""
    return df.select(key, F.explode(split_literal(F.col(text), sep)).alias("word"))


def split_expand(df: DataFrame, text: str, sep: str, prefix: str) -> DataFrame:
    """The pieces of ``text`` as columns ``prefix0``, ``prefix1``, ...: as many as the longest row has, so none is lost.

    One aggregate finds the width. It is a schema, so more columns than ``spark.sql.pivotMaxValues`` are an error.
    """
    pieces = split_literal(F.col(text), sep)
    width = df.agg(F.max(F.size(pieces))).first()[0] or 0
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    if width > most:
        raise ValueError(f"{text} has up to {width} pieces, too many to become columns ({most})")
    return df.select("*", *[F.get(pieces, F.lit(i)).alias(f"{prefix}{i}") for i in range(width)])
