"""JSON-lines sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def parse_json_lines(lines: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Parse the text column ``value``; adds ``reject_reason``, NULL for a good line.

    Blank lines, text that is not JSON, JSON that is not an object and objects without a required
    field all stay in the result with their reason, so nothing is lost silently.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    record = F.col("record")
    missing = F.lit(False)
    for name in required:
        missing = missing | record[name].isNull()
    reason = (
        F.when(F.trim("value") == "", "blank line")
        .when(record.isNull() | record[CORRUPT].isNotNull(), "not a JSON object of this schema")
        .when(missing, "required field missing")
    )
    return lines.withColumn("record", parsed).select(
        *[record[f.name].alias(f.name) for f in schema.fields], F.col("value").alias("line"), reason.alias("reject_reason")
    )


def read_jsonl_tolerant(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, required: tuple[str, ...] = ("event_type",)
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with reason) of the JSON lines below ``path``."""
    parsed = parse_json_lines(spark.read.text(path), schema, required)
    good = parsed.filter(F.col("reject_reason").isNull()).drop("line", "reject_reason")
    rejects = parsed.filter(F.col("reject_reason").isNotNull()).select("line", "reject_reason")
    return good, rejects


def read_jsonl_strict(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The first bad line fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
