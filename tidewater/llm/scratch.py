"""Intermediate tables of this package: as in ``tidewater.session``, and the job's shuffle files go with the job."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidewater import session

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, but for those that ``materialise`` is told to keep."""
    with session.scratch_scope(spark):
        yield


def materialise(df: DataFrame, label: str, few_match: bool = False, outlives: bool = False, batch_bytes: int | None = None) -> DataFrame:
    """Writes ``df`` to the shared scratch folder and reads it back.

    Nothing can need the job's shuffle files once the table is there, so Spark removes them at once instead of when the driver
    next collects garbage; disks then hold one step's shuffle, not all of them. ``few_match``: the step joins a large table
    with the few of its rows that are wanted, so Spark may drop the others by a runtime Bloom filter at any size of the table
    (by itself it does so from 10 GB), before they are shuffled. ``outlives``: the table is not deleted at the end of ``released``.
    ``batch_bytes``: the most that goes to a Python worker at once; Spark's own limit suits rows of a few bytes, not packed ones.
    """
    wanted = {_CLEANUP: "true"} | ({_BLOOM: "0"} if few_match else {}) | ({_BATCH: str(batch_bytes)} if batch_bytes else {})
    with _settings(df.sparkSession, wanted):
        if not outlives:
            return session.materialise(df, label)
        path = session.scratch_dir(df.sparkSession, label, scoped=False)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
