"""Event revenue workload: count all wanted events and sum their amounts by a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.columns import amount_with_fallback, month_key_text
from tidewater.operators.filters import filter_types

STRATEGIES = ("currency", "source", "month")


def revenue_key(strategy: str) -> Column:
    if strategy == "month":
        return month_key_text(F.col("ts"))
    if strategy in STRATEGIES:
        return F.col(strategy)
    raise ValueError(f"unknown strategy {strategy}, expected one of {STRATEGIES}")


def partial_revenue(events: DataFrame, strategy: str, event_types: str | list[str] = "purchase") -> DataFrame:
    """Count and revenue per key, the missing key included; works on batch and streaming frames alike."""
    amount = amount_with_fallback(F.col("price"), F.col("amount"))
    return (
        filter_types(events, "event_type", event_types)
        .groupBy(revenue_key(strategy).alias("revenue_key"))
        .agg(F.count("*").alias("n_events"), F.sum(amount).alias("revenue"))
    )


def revenue_report(partial: DataFrame) -> DataFrame:
    """Revenue of the known keys beside the count of all events, those without a key included.

    The window runs over one row per currency, source or month, never over events.
    """
    total = F.sum("n_events").over(Window.partitionBy())
    return (
        partial.withColumn("total_count", total)
        .filter(F.col("revenue_key").isNotNull())
        .select("revenue_key", "n_events", "revenue", "total_count")
    )


def revenue_by_key(events: DataFrame, strategy: str = "currency", event_types: str | list[str] = "purchase") -> DataFrame:
    """One scan, one shuffle of partial sums."""
    return revenue_report(partial_revenue(events, strategy, event_types))
