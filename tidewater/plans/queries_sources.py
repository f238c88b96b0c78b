"""Sources, sinks and generators: the tables are written in each format and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.plans.queries_events import EVENT_SQL, event_lines, event_rows
from tidewater.plans.registry import query, rounded
from tidewater.sources import files, generate
from tidewater.sources.jsonl import EVENT_SCHEMA, parse_json_lines, read_jsonl_strict

END_EPOCH = 1_735_689_600  # 2025-01-01T00:00:00Z
SEED = 7


@query(
    "scan_jsonl_tolerant",
    EVENT_SQL
    + """, tagged AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN 'not a JSON object of this schema'
      WHEN event_id % 11 = 0 THEN 'blank line' WHEN event_id % 13 = 0 THEN 'required field missing'
      WHEN event_id % 17 = 0 THEN 'not a JSON object of this schema' ELSE 'good' END AS status FROM ev)
    SELECT status, count(*) AS n_lines, round(sum(CASE WHEN status = 'good' THEN price END), 2) AS price_sum
    FROM tagged GROUP BY status""",
)
def _(t):
    rows = event_rows(t).withColumn("event_id", F.col("event_id").cast("string"))
    i = F.col("event_id").cast("long")
    good = F.to_json(F.struct(*rows.columns))
    line = (
        F.when(i % 7 == 0, F.concat(F.lit("{broken "), good))
        .when(i % 11 == 0, "")
        .when(i % 13 == 0, F.to_json(F.struct("event_id", "source")))
        .when(i % 17 == 0, "5")
        .otherwise(good)
    )
    landing = t.scratch("jsonl-mixed")
    rows.select(line.alias("value")).write.text(landing)
    parsed = parse_json_lines(t.spark.read.text(landing), EVENT_SCHEMA, ("event_type",))
    status = F.coalesce("reject_reason", F.lit("good"))
    return parsed.groupBy(status.alias("status")).agg(
        F.count("*").alias("n_lines"),
        F.round(F.sum(F.when(F.col("reject_reason").isNull(), F.col("price"))), 2).alias("price_sum"),
    )


@query("scan_jsonl_strict", EVENT_SQL + "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, user_id, price, amount, currency, ts, source FROM ev")
def _(t):
    landing = t.scratch("jsonl-clean")
    event_lines(t).write.text(landing)
    return read_jsonl_strict(t.spark, landing)


@query(
    "scan_csv_text_glob",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows, round(sum(l_extendedprice), 2) AS price_sum,
    CAST(sum(length(CAST(l_orderkey AS VARCHAR))) AS BIGINT) AS key_chars FROM lineitem GROUP BY 1, 2""",
)
def _(t):
    """Two drops whose files have their columns in opposite orders."""
    landing = t.scratch("lineitem-csv")
    odd = F.col("l_orderkey") % 2 == 1
    files.write_csv(t.lineitem.filter(odd), f"{landing}/a")
    files.write_csv(t.lineitem.filter(~odd).select(*reversed(t.lineitem.columns)), f"{landing}/b")
    rows = files.read_csv_text(t.spark, f"{landing}/*/*.csv")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_rows"),
        F.round(F.sum(F.col("l_extendedprice").cast("double")), 2).alias("price_sum"),
        F.sum(F.length("l_orderkey").cast("long")).alias("key_chars"),
    )


@query(
    "scan_csv_options",
    """SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS nation,
    CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance FROM customer""",
)
def _(t):
    landing = t.scratch("customer-csv")
    k = F.col("c_custkey")
    text = t.customer.select(
        k.cast("string"),
        "c_name",
        F.when(k % 5 == 0, "NA").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.when(k % 7 == 0, "-").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
    )
    files.write_csv(text, landing, sep=";")
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("nation", T.IntegerType()),
            T.StructField("balance", T.DoubleType()),
        ]
    )
    return files.read_csv_options(t.spark, landing, schema, sep=";", null_values=("NA", "-", ""))


@query(
    "tag_source_by_file_name",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'R' THEN 'green' ELSE 'fhv' END AS source_tag, count(*) AS n_rows,
    CAST(sum(l_partkey) AS BIGINT) AS pickup_sum, CAST(sum(l_suppkey) AS BIGINT) AS vendor_sum FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1""",
)
def _(t):
    """Three feeds with different headers, and a file of none of them, in one folder."""
    landing = t.scratch("mixed-landing")
    pickup, vendor = F.col("l_partkey"), F.col("l_suppkey")
    headers = {
        "A": ("Yellow_tripdata.csv", [vendor.alias("VendorID"), pickup.alias("PULocationID")]),
        "R": ("2024_green.csv", [pickup.alias("PULocationID"), vendor.alias("VendorID")]),
        "N": ("For_Hire_Vehicle.csv", [pickup.alias("PUlocationID"), F.lit("x").alias("SR_Flag"), vendor.alias("dispatching_base_num")]),
    }
    for flag, (name, columns) in headers.items():
        rows = t.lineitem.filter((F.col("l_returnflag") == flag) & (F.col("l_linenumber") != 7)).select(*columns)
        rows.write.option("header", True).csv(f"{landing}/parts/{flag}")
        _rename_parts(t.spark, f"{landing}/parts/{flag}", f"{landing}/{name}")
    files.write_csv(t.lineitem.filter("l_linenumber = 7").select("l_orderkey"), f"{landing}/other")
    totals = []
    for feed in files.read_landing_tagged(t.spark, landing).values():
        names = {c.lower(): c for c in feed.columns}
        base = F.col(names.get("vendorid") or names["dispatching_base_num"]).cast("long")
        totals.append(feed.select("source_tag", F.col(names["pulocationid"]).cast("long").alias("p"), base.alias("v")))
    both = reduce(DataFrame.unionByName, totals).groupBy("source_tag")
    return both.agg(F.count("*").alias("n_rows"), F.sum("p").alias("pickup_sum"), F.sum("v").alias("vendor_sum"))


def _rename_parts(spark, folder: str, name: str) -> None:
    """Moves the part files of ``folder`` beside it under ``name`` with a number: files as they arrive in a landing folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(str(s.getPath()) for s in fs.listStatus(path) if s.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        stem, _, ending = name.rpartition(".")
        fs.rename(spark._jvm.org.apache.hadoop.fs.Path(part), spark._jvm.org.apache.hadoop.fs.Path(f"{stem}_{i}.{ending}"))


@query("sink_csv_header", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def _(t):
    out = t.scratch("nation-csv")
    files.write_csv(t.nation, out)
    return files.read_csv_text(t.spark, out)


@query("scan_parquet", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 200000")
def _(t):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").filter("o_totalprice > 200000")


@query("scan_json", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 200000")
def _(t):
    out = t.scratch("orders-json")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.write.json(out)
    return t.spark.read.schema(rows.schema).json(out).filter("o_totalprice > 200000")


@query(
    "table_ctas_schema",
    """SELECT 'main' AS schema_name, c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT 'demo', c_custkey, c_name FROM customer WHERE c_acctbal < 0""",
)
def _(t):
    location = t.scratch("schemas")
    suffix = location.rsplit("-", 1)[1]
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    main = files.create_table_as(rows.filter("c_mktsegment = 'MACHINERY'"), f"main_{suffix}", "customer", f"{location}/main")
    demo = files.create_table_as(rows.filter("c_acctbal < 0"), f"demo_{suffix}", "customer", f"{location}/demo")
    return t.spark.sql(
        f"""SELECT 'main' AS schema_name, c_custkey, c_name FROM {main}
        UNION ALL SELECT 'demo', c_custkey, c_name FROM {demo}"""
    )


@query(
    "temp_view_join_values",
    """WITH labels(key, label) AS (VALUES (0, 'south'), (3, 'north'))
    SELECT n.n_nationkey, n.n_name, labels.label FROM nation n JOIN labels ON n.n_regionkey = labels.key""",
)
def _(t):
    return t.spark.sql(
        """WITH labels AS (SELECT * FROM VALUES (0, 'south'), (3, 'north') AS v(key, label))
        SELECT n.n_nationkey, n.n_name, labels.label FROM {nation} n JOIN labels ON n.n_regionkey = labels.key""",
        nation=t.nation,
    )


@query(
    "temp_view_distinct_case",
    """WITH info AS (SELECT DISTINCT c_mktsegment, CASE c_mktsegment WHEN 'MACHINERY' THEN 'industry'
      WHEN 'HOUSEHOLD' THEN 'home' ELSE 'other' END AS description FROM customer WHERE c_mktsegment IS NOT NULL)
    SELECT customer.*, info.description FROM customer JOIN info ON customer.c_mktsegment = info.c_mktsegment""",
)
def _(t):
    info = (
        t.customer.filter(F.col("c_mktsegment").isNotNull())
        .select(
            "c_mktsegment",
            F.when(F.col("c_mktsegment") == "MACHINERY", "industry")
            .when(F.col("c_mktsegment") == "HOUSEHOLD", "home")
            .otherwise("other")
            .alias("description"),
        )
        .distinct()
    )
    return t.customer.alias("c").join(info.alias("d"), "c_mktsegment").select("c.*", "d.description")


def _uniform_sql(slot: int) -> str:
    return f"(CAST('0x' || substr(h, {1 + 8 * slot}, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def _normal_sql(slot: int) -> str:
    return f"(sqrt(-2.0 * ln(1.0 - {_uniform_sql(slot)})) * cos(2.0 * pi() * {_uniform_sql(slot + 1)}))"


@query(
    "gen_events",
    f"""WITH digests AS (SELECT sha256(event_id || '-{SEED}') AS h FROM events),
    typed AS (SELECT h, CASE WHEN {_uniform_sql(0)} < 0.6 THEN 'view' WHEN {_uniform_sql(0)} < 0.85 THEN 'click'
      WHEN {_uniform_sql(0)} < 0.98 THEN 'purchase' ELSE 'refund' END AS event_type FROM digests)
    SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-'
      || substr(h, 49, 12) AS event_id, event_type, CAST(floor({_uniform_sql(1)} * 50000) + 1 AS BIGINT) AS user_id,
      CASE WHEN event_type IN ('purchase', 'refund') THEN round({_uniform_sql(2)} * 495.0 + 5.0, 2) ELSE 0.0 END AS price,
      CASE WHEN {_uniform_sql(3)} < 0.5 THEN 'USD' ELSE 'EUR' END AS currency,
      strftime(make_timestamp(({END_EPOCH} - 2592000 + CAST(floor({_uniform_sql(4)} * 2592001) AS BIGINT)) * 1000000),
               '%Y-%m-%dT%H:%M:%S+00:00') AS ts,
      CASE CAST(floor({_uniform_sql(5)} * 3) AS INTEGER) WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'api' END AS source
    FROM typed""",
)
def _(t):
    return generate.events_for_ids(t.events, "event_id", SEED, END_EPOCH)


@query(
    "random_columns",
    f"""WITH digests AS (SELECT p_partkey, sha256(p_partkey || '-{SEED}') AS h FROM part)
    SELECT p_partkey, round({_uniform_sql(0)}, 6) AS uniform, round({_normal_sql(1)}, 6) AS std_normal,
      round({_normal_sql(3)} * 2.0 + 10.0, 6) AS normal, CAST(floor({_uniform_sql(5)} * 90) + 10 AS INTEGER) AS integer
    FROM digests""",
)
def _(t):
    return rounded(generate.random_columns(t.part.select("p_partkey"), "p_partkey", SEED, 10.0, 2.0, 10, 100), 6)
