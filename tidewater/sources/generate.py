"""Seeded synthetic columns and events.

Every value is a function of (row id, seed) only, so the rows are the same for any number of
partitions and after any task retry.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event mix, currencies and sources of the event workload.
EVENT_SHARES = (("view", 0.60), ("click", 0.25), ("purchase", 0.13), ("refund", 0.02))
PRICED_TYPES = ("purchase", "refund")
CURRENCIES = ("USD", "EUR")
SOURCES = ("web", "mobile", "api")
EVENT_DAYS = 30
EVENT_USERS = 50_000
PRICE_LOW, PRICE_HIGH = 5.0, 500.0

_DIGEST = "__digest"


def row_digest(row_id: Column, seed: int) -> Column:
    """64 hex digits per row: room for eight independent uniforms."""
    return F.sha2(F.concat_ws("-", row_id.cast("string"), F.lit(str(seed))), 256)


def uniform(digest: Column, slot: int) -> Column:
    """Uniform in [0, 1) from the eight hex digits of ``slot`` (0..7)."""
    return F.conv(F.substring(digest, 1 + 8 * slot, 8), 16, 10).cast("double") / F.lit(float(2**32))


def standard_normal(digest: Column, slot: int) -> Column:
    """Standard normal by the Box-Muller transform of slots ``slot`` and ``slot + 1``."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(digest, slot)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(digest, slot + 1))


def random_columns(df: DataFrame, id_col: str, seed: int, mu: float, sigma: float, low: int, high: int) -> DataFrame:
    """Adds ``uniform``, ``std_normal``, ``normal`` (mu, sigma) and ``integer`` in [low, high)."""
    digest = F.col(_DIGEST)
    return df.withColumn(_DIGEST, row_digest(F.col(id_col), seed)).select(
        *df.columns,
        uniform(digest, 0).alias("uniform"),
        standard_normal(digest, 1).alias("std_normal"),
        (standard_normal(digest, 3) * sigma + mu).alias("normal"),
        (F.floor(uniform(digest, 5) * (high - low)) + low).cast("int").alias("integer"),
    )


def _pick(values: tuple[str, ...], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * len(values)) + 1).cast("int"))


def events_for_ids(ids: DataFrame, id_col: str, seed: int, end_epoch: int) -> DataFrame:
    """One synthetic event per id, with times spread over the days before ``end_epoch`` (UTC seconds)."""
    digest = F.col(_DIGEST)
    event_type, bound = None, 0.0
    for name, share in EVENT_SHARES[:-1]:
        bound = round(bound + share, 10)
        condition = uniform(digest, 0) < bound
        event_type = F.when(condition, name) if event_type is None else event_type.when(condition, name)
    event_type = event_type.otherwise(EVENT_SHARES[-1][0])
    span = EVENT_DAYS * 86_400
    seconds = F.lit(end_epoch - span) + F.floor(uniform(digest, 4) * (span + 1))
    # without a zone: the text does not depend on the session's
    moment = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=seconds)
    return (
        ids.select(row_digest(F.col(id_col), seed).alias(_DIGEST))
        .withColumn("event_type", event_type)
        .select(
            F.concat_ws(
                "-",
                F.substring(digest, 1, 8),
                F.substring(digest, 9, 4),
                F.substring(digest, 13, 4),
                F.substring(digest, 17, 4),
                F.substring(digest, 49, 12),
            ).alias("event_id"),
            "event_type",
            (F.floor(uniform(digest, 1) * EVENT_USERS) + 1).alias("user_id"),
            F.when(
                F.col("event_type").isin(*PRICED_TYPES),
                F.round(uniform(digest, 2) * (PRICE_HIGH - PRICE_LOW) + PRICE_LOW, 2),
            )
            .otherwise(0.0)
            .alias("price"),
            _pick(CURRENCIES, uniform(digest, 3)).alias("currency"),
            F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("ts"),
            _pick(SOURCES, uniform(digest, 5)).alias("source"),
        )
    )


def generate_events(spark: SparkSession, count: int = 5_000_000, seed: int = 0, end_epoch: int = 1_735_689_600) -> DataFrame:
    """``count`` synthetic events."""
    return events_for_ids(spark.range(count), "id", seed, end_epoch)
