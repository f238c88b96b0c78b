"""Named queries: an operator bound to the standard tables, with an independent SQL statement of the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``f(tables)`` under ``name``."""

    def register(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Given columns (default: all double columns) rounded, order kept."""
    chosen = set(columns) or {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def load_all() -> None:
    """Imports every module that registers queries."""
    from tidewater.plans import (  # noqa: F401
        queries_events,
        queries_matrix,
        queries_quality,
        queries_relational,
        queries_scalars,
        queries_sources,
        queries_tables,
        queries_trips,
    )
