"""The event revenue workload over arriving JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.filters import filter_types
from tidewater.plans.events import partial_revenue, revenue_report
from tidewater.sources.jsonl import EVENT_SCHEMA

# Versions of changes that are put together into one table.
COMPACT_AFTER = 16
VERSION = "__version"


def read_event_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """``max_files`` bounds a micro-batch; unparsable lines come without an event type and match no filter."""
    reader = spark.readStream.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def _empty(spark: SparkSession, folder: str) -> bool:
    """Whether a landing folder has no file yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(path) or not any(s.getPath().getName()[0] not in "._" for s in fs.listStatus(path))


class VersionedTable:
    """A table of one row per key below ``folder``, kept up by batches that bring changed keys only.

    ``changes/version=b`` holds the rows of batch b; a batch that is repeated replaces its folder. From time to time all that
    is there becomes ``base/version=b``, a row for each key with the version it is from, and the changes that it holds go.
    The base before stays until the next one is there, for those who still read it, so at most two bases exist.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str):
        self.spark, self.folder, self.schema, self.key = spark, folder, schema, key

    def _versions(self, kind: str) -> list[int]:
        """Versions that were written to their end, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("version=")]
        done = [p for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().removeprefix("version=")) for p in done)

    def _path(self, kind: str, version: int) -> str:
        return f"{self.folder}/{kind}/version={version}"

    def _drop(self, kind: str, version: int) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(kind, version))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def write_changes(self, rows: DataFrame, version: int, compact_after: int) -> None:
        rows.withColumn(VERSION, F.lit(version).cast("long")).write.mode("overwrite").parquet(self._path("changes", version))
        if len(self._versions("changes")) >= compact_after:
            self.compact()

    def _newest(self) -> DataFrame:
        """One row per key: that of the greatest version."""
        bases, changes = self._versions("base")[-1:], self._versions("changes")
        paths = [self._path("base", v) for v in bases] + [self._path("changes", v) for v in changes]
        whole = f"{self.schema}, {VERSION} bigint"
        rows = self.spark.read.schema(whole).parquet(*paths) if paths else self.spark.createDataFrame([], whole)
        last = F.max_by(F.struct(*rows.columns), VERSION).alias("row")
        return rows.groupBy(F.col(self.key).alias("__key")).agg(last).select("row.*")

    def compact(self) -> None:
        changes = self._versions("changes")
        if not changes:
            return
        bases = self._versions("base")
        self._newest().write.mode("overwrite").parquet(self._path("base", changes[-1]))
        for version in changes:
            self._drop("changes", version)
        for version in [b for b in bases if b != changes[-1]][:-1]:
            self._drop("base", version)

    def read(self) -> DataFrame:
        return self._newest().drop(VERSION)


def stream_revenue(
    spark: SparkSession,
    folder: str,
    out: str,
    strategy: str = "currency",
    event_types: str | list[str] = "purchase",
    max_files: int | None = None,
    compact_after: int = COMPACT_AFTER,
) -> DataFrame:
    """Revenue by key after all files present. State is one running sum per key.

    Each micro-batch writes the keys that it changed (update mode) as a version of its own, so a repeated batch leaves the
    same table; the checkpoint sits beside the output and a restart goes on from there.
    """
    if _empty(spark, folder):
        return revenue_report(partial_revenue(spark.createDataFrame([], EVENT_SCHEMA), strategy, event_types))
    revenue = partial_revenue(read_event_stream(spark, folder, max_files), strategy, event_types)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in revenue.schema.fields)
    table = VersionedTable(spark, f"{out}/revenue", schema, "revenue_key")
    query = (
        revenue.writeStream.outputMode("update")
        .option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(lambda batch, batch_id: table.write_changes(batch, batch_id, compact_after))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return revenue_report(table.read())


def stream_batch_counts(
    spark: SparkSession, folder: str, out: str, event_types: str | list[str] = "purchase", max_files: int | None = 1
) -> DataFrame:
    """Events per batch: one row per micro-batch, replaced as a whole when the batch is repeated.

    A batch has at most ``max_files`` files; without a bound it is all that arrived since the batch before.
    """
    counts = f"{out}/counts"
    if _empty(spark, folder):
        return spark.createDataFrame([], "n_events bigint, batch_id int")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.count("*").alias("n_events")).write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    query = (
        filter_types(read_event_stream(spark, folder, max_files), "event_type", event_types)
        .select("event_type")
        .writeStream.option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("n_events bigint, batch_id int").parquet(counts)
