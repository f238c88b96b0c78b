"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even where the split costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a map stage whose rows changed when it ran again makes its readers start over
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "tidewater", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the library's settings; ``master`` and other deployment settings come from the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary folder only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):  # executors of a local-cluster have folders of their own
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="tidewater-")
    return _local_scratch[context.applicationId]


_scopes: list[list[str]] = []


def scratch_dir(spark: SparkSession, label: str, scoped: bool = True) -> str:
    """A path below the scratch folder that no other call returns; unless ``scoped``, no ``scratch_scope`` deletes it."""
    path = f"{scratch_root(spark)}/tidewater/{label}-{uuid.uuid4().hex}"
    if _scopes and scoped:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch paths handed out inside, when it ends. Results that read them have to be written before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the scratch folder and read it back.

    Cuts the lineage and freezes the rows, so that several passes over the result see the same data
    even when an executor is lost in between.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
