"""Trip workload over feeds derived from ``lineitem``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import parse_number_grouped, parse_timestamp_multi
from tidewater.operators.project import add_missing_columns, cast_with_rejects, rename_by_map
from tidewater.plans import trips as job
from tidewater.plans.registry import query, rounded
from tidewater.sources.files import read_csv_text, write_csv, write_parquet
from tidewater.tables import Tables

YEARS = (1996, 1997, 1998)
FEED_FLAG = {"yellow": "A", "green": "R", "fhv": "N"}

TRIPS_SQL = """WITH trips AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS vendor_id, l_shipdate AS pickup_datetime,
         l_shipdate + CASE WHEN l_linenumber = 7 THEN to_hours(-1) ELSE to_hours(l_linenumber) END AS dropoff_datetime,
         CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS passenger_count,
         CASE WHEN l_returnflag <> 'N' THEN l_quantity - 2 END AS trip_distance,
         CAST(l_partkey AS VARCHAR) AS pickup_location_id,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_suppkey % 4 AS INTEGER) END AS payment_type,
         CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS fare_amount,
         CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * l_discount END AS tip_amount,
         CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * (1 + l_tax) END AS total_amount,
         CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'R' THEN 'green' ELSE 'fhv' END AS taxi_type,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         l_orderkey, l_linenumber
  FROM lineitem),
checked AS (
  SELECT *, (trip_distance IS NULL OR trip_distance > 0) AND (fare_amount IS NULL OR fare_amount > 0)
            AND (pickup_datetime IS NULL OR dropoff_datetime IS NULL OR pickup_datetime < dropoff_datetime) AS ok
  FROM trips),
clean AS (SELECT * FROM checked WHERE ok),
analysed AS (SELECT * FROM clean WHERE year IN (1996, 1997, 1998))
"""


def text_feeds(t: Tables, spoilt: dict | None = None) -> dict[str, DataFrame]:
    """Three feeds of text columns under their own names; the date format changes from row to row. ``spoilt`` has texts that
    take the place of a column's where they are not NULL."""
    n = F.col("l_linenumber")
    drop = F.col("l_shipdate") + F.make_dt_interval(hours=F.when(n == 7, F.lit(-1)).otherwise(n))

    def stamp(c):
        return (
            F.when(n % 3 == 0, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
            .when(n % 3 == 1, F.date_format(c, "MM/dd/yyyy hh:mm:ss a"))
            .otherwise(F.date_format(c, "M/d/yyyy h:mm:ss a"))
        )

    price = F.col("l_extendedprice")
    fares = {
        "passenger_count": n,
        "trip_distance": F.col("l_quantity") - 2,
        "payment_type": F.col("l_suppkey") % 4,
        "fare_amount": F.format_number(price, 2),
        "tip_amount": price * F.col("l_discount"),
        "total_amount": price * (1 + F.col("l_tax")),
    }
    shared = {
        "vendor_id": F.col("l_suppkey"),
        "pickup_datetime": stamp(F.col("l_shipdate")),
        "dropoff_datetime": stamp(drop),
        "pickup_location_id": F.col("l_partkey"),
        "dropoff_location_id": F.col("l_suppkey"),
    }
    feeds = {}
    for feed, flag in FEED_FLAG.items():
        own = {new: old for old, new in job.FEED_NAMES[feed].items()}
        columns = shared if feed == "fhv" else {**shared, "rate_code_id": n, **fares}
        columns = {name: F.coalesce((spoilt or {}).get(name, F.lit(None)), c.cast("string")) for name, c in columns.items()}
        feeds[feed] = t.lineitem.filter(F.col("l_returnflag") == flag).select(
            *[c.cast("string").alias(own.get(name, name)) for name, c in columns.items()]
        )
    return feeds


_feeds: dict[str, dict[str, DataFrame]] = {}
_written: dict[tuple, str] = {}


def _once(t: Tables, label: str, write) -> str:
    """Folder that ``write`` filled, once per session and state of the input's files."""
    # a listing: the files themselves are not opened
    files = t.spark.read.format("binaryFile").load(f"{t.folder}/lineitem.parquet").select("path", "modificationTime", "length")
    state = tuple(sorted((r[0], str(r[1]), r[2]) for r in files.collect()))
    key = (t.spark.sparkContext.applicationId, state, label)
    if key not in _written:
        path = t.scratch(label)
        write(path)
        _written[key] = path
    return _written[key]


def landed_feeds(t: Tables) -> dict[str, DataFrame]:
    """The feeds as they arrive: one folder of headered CSV files each, every column read as text."""

    def write(path: str) -> None:
        for name, feed in text_feeds(t).items():
            write_csv(feed, f"{path}/{name}")

    landing = _once(t, "trip-feeds", write)
    if landing not in _feeds:  # plans, not rows: the headers of a landing that no longer changes are looked at once
        _feeds[landing] = {name: read_csv_text(t.spark, f"{landing}/{name}/*.csv") for name in job.FEED_NAMES}
    return _feeds[landing]


def conformed(t: Tables) -> DataFrame:
    """The conformed table: parsed and written once per session, read by every report."""
    path = _once(t, "trips", lambda out: write_parquet(job.conform_feeds(landed_feeds(t)), out, compression="zstd"))
    return t.spark.read.schema(", ".join(f"{c} {kind}" for c, kind in job.TARGET.items())).parquet(path)


def analysed(t: Tables) -> DataFrame:
    return job.in_years(job.split_valid_invalid(conformed(t))[0], YEARS)


def each_feed(t: Tables, f) -> DataFrame:
    """``f(feed, name)`` of the three feeds, one after the other."""
    return reduce(DataFrame.unionByName, [f(feed, name).withColumn("feed", F.lit(name)) for name, feed in landed_feeds(t).items()])


@query(
    "rename_by_map",
    "SELECT CAST(l_suppkey AS VARCHAR) AS vendor_id, CAST(l_partkey AS VARCHAR) AS pickup_location_id, "
    "CAST(l_suppkey AS VARCHAR) AS dropoff_location_id, "
    "CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'R' THEN 'green' ELSE 'fhv' END AS feed FROM lineitem",
)
def _(t):
    names = ("vendor_id", "pickup_location_id", "dropoff_location_id")
    return each_feed(t, lambda feed, name: rename_by_map(feed, job.FEED_NAMES[name]).select(*names))


@query(
    "add_missing_columns",
    """SELECT CASE WHEN l_returnflag = 'N' THEN CAST(l_suppkey AS VARCHAR) END AS dispatching_base_num,
    CASE WHEN l_returnflag <> 'N' THEN CAST(l_suppkey AS VARCHAR) END AS VendorID,
    CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS VARCHAR) END AS passenger_count, CAST(NULL AS DOUBLE) AS surcharge,
    CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'R' THEN 'green' ELSE 'fhv' END AS feed FROM lineitem""",
)
def _(t):
    wanted = {"dispatching_base_num": "string", "VendorID": "string", "passenger_count": "string", "surcharge": "double"}
    return each_feed(t, lambda feed, _: add_missing_columns(feed.select(*[c for c in feed.columns if c in wanted]), wanted).select(*wanted))


@query(
    "parse_rejects",
    """WITH bad AS (SELECT CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'R' THEN 'green' ELSE 'fhv' END AS taxi_type, l_linenumber AS n FROM lineitem)
    SELECT taxi_type, column_name, CAST(sum(CASE WHEN column_name = 'pickup_datetime' AND n = 5 THEN 1
      WHEN column_name = 'passenger_count' AND n = 6 THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected
    FROM bad, (SELECT unnest(['pickup_datetime', 'dropoff_datetime', 'passenger_count', 'payment_type', 'trip_distance', 'fare_amount',
      'tip_amount', 'total_amount']) AS column_name) WHERE taxi_type <> 'fhv' OR column_name IN ('pickup_datetime', 'dropoff_datetime')
    GROUP BY 1, 2""",
)
def _(t):
    """Texts that do not parse, per feed and column; ``6.5`` passengers are no whole number, ``2.0`` would be."""
    n = F.col("l_linenumber")
    passengers = F.when(n == 6, "6.5").otherwise(F.concat(n.cast("string"), F.lit(".0")))
    feeds = text_feeds(t, {"pickup_datetime": F.when(n == 5, "no date"), "passenger_count": passengers})
    reports = [job.parse_rejects(feed, name).select(F.lit(name).alias("taxi_type"), "*") for name, feed in feeds.items()]
    return reduce(DataFrame.unionByName, reports)


@query(
    "cast_with_rejects",
    """SELECT count(*) AS n_rows, CAST(sum(CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected,
    CAST(sum(CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END) AS BIGINT) AS key_sum FROM orders""",
)
def _(t):
    text = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("#"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_custkey").cast("string"))
    rows, rejects = cast_with_rejects(t.orders.select(text.alias("custkey")), {"custkey": "bigint"})
    sums = rows.agg(F.count("*").alias("n_rows"), F.sum("custkey").alias("key_sum"))
    return sums.crossJoin(F.broadcast(rejects.select("n_rejected"))).select("n_rows", "n_rejected", "key_sum")


@query(
    "select_target_order",
    TRIPS_SQL
    + """SELECT vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
    CASE WHEN passenger_count IS NOT NULL THEN CAST(l_linenumber AS VARCHAR) END AS rate_code_id, pickup_location_id,
    vendor_id AS dropoff_location_id, payment_type, fare_amount, CAST(NULL AS DOUBLE) AS extra,
    CAST(NULL AS DOUBLE) AS mta_tax, round(tip_amount, 4) AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount,
    CAST(NULL AS DOUBLE) AS improvement_surcharge, round(total_amount, 4) AS total_amount,
    CAST(NULL AS VARCHAR) AS sr_flag, taxi_type, year, month FROM trips""",
)
def _(t):
    rows = job.conform_feeds(landed_feeds(t)).select(*job.TARGET)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")}
    return rounded(rows.withColumns(times), 4, "tip_amount", "total_amount")


@query(
    "parse_timestamp_multi",
    """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber <> 5 THEN l_shipdate END AS shipped FROM lineitem""",
)
def _(t):
    n = F.col("l_linenumber")
    text = (
        F.when(n == 5, "not a date")
        .when(n % 3 == 0, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
        .when(n % 3 == 1, F.date_format("l_shipdate", "MM/dd/yyyy hh:mm:ss a"))
        .otherwise(F.date_format("l_shipdate", "M/d/yyyy h:mm:ss a"))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", parse_timestamp_multi(text).cast("timestamp_ntz").alias("shipped"))


@query("parse_number_grouped", "SELECT l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", parse_number_grouped(F.format_number("l_extendedprice", 2)).alias("price")
    )


@query(
    "derive_year_month",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


FEED_TOTALS_SQL = """SELECT taxi_type, count(*) AS n_rows, count(fare_amount) AS n_fares, round(sum(fare_amount), 2) AS fares,
    round(sum(tip_amount), 2) AS tips, min(pickup_datetime) AS first_pickup, max(dropoff_datetime) AS last_dropoff
    FROM trips GROUP BY taxi_type"""


def feed_totals(trips: DataFrame) -> DataFrame:
    return trips.groupBy("taxi_type").agg(
        F.count("*").alias("n_rows"),
        F.count("fare_amount").alias("n_fares"),
        F.round(F.sum("fare_amount"), 2).alias("fares"),
        F.round(F.sum("tip_amount"), 2).alias("tips"),
        F.min("pickup_datetime").cast("timestamp_ntz").alias("first_pickup"),
        F.max("dropoff_datetime").cast("timestamp_ntz").alias("last_dropoff"),
    )


@query("conform_feeds", TRIPS_SQL + FEED_TOTALS_SQL)
def _(t):
    return feed_totals(job.conform_feeds(landed_feeds(t)))


@query("union_by_name", TRIPS_SQL + "SELECT taxi_type, vendor_id, month, fare_amount FROM trips")
def _(t):
    return conformed(t).select("taxi_type", "vendor_id", "month", "fare_amount")


@query(
    "split_valid_invalid",
    TRIPS_SQL
    + """SELECT taxi_type, CASE WHEN ok THEN 'valid' ELSE 'invalid' END AS branch, count(*) AS n_rows
    FROM checked GROUP BY ALL""",
)
def _(t):
    valid, invalid = job.split_valid_invalid(conformed(t))
    both = valid.withColumn("branch", F.lit("valid")).unionByName(invalid.withColumn("branch", F.lit("invalid")))
    return both.groupBy("taxi_type", "branch").agg(F.count("*").alias("n_rows"))


@query(
    "validity_counts",
    TRIPS_SQL
    + """SELECT count(*) AS all_rows, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows,
    CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS invalid_rows FROM checked""",
)
def _(t):
    return job.validity_counts(conformed(t))


@query("group_count_one_key", TRIPS_SQL + "SELECT year, count(*) AS n_trips FROM analysed GROUP BY year")
def _(t):
    return job.trips_by_year(analysed(t)).orderBy("year")


@query(
    "group_count_two_keys",
    TRIPS_SQL + "SELECT year, taxi_type, count(*) AS n_trips FROM analysed GROUP BY year, taxi_type",
)
def _(t):
    return job.trips_by_year_and_type(analysed(t)).orderBy("year", "taxi_type")


@query(
    "lag_growth_pct",
    TRIPS_SQL
    + """, counts AS (SELECT year, count(*) AS n_trips FROM analysed GROUP BY year),
    prev AS (SELECT *, lag(n_trips) OVER (ORDER BY year) AS prev_count FROM counts)
    SELECT *, round((n_trips - prev_count) * 1.0 / prev_count * 100, 2) AS growth_pct FROM prev""",
)
def _(t):
    return job.yearly_growth(analysed(t))


@query(
    "summary_avg_median",
    TRIPS_SQL
    + "SELECT "
    + ", ".join(
        f"round(avg({m}), 4) AS avg_{m}, round(quantile_disc({m}, 0.5), 4) AS median_{m}" for m in job.MEASURES
    )
    + " FROM analysed",
)
def _(t):
    return rounded(job.summary(analysed(t)), 4)


@query(
    "period_compare",
    TRIPS_SQL
    + "SELECT year, count(*) AS n_trips, "
    + ", ".join(f"round(avg({m}), 4) AS avg_{m}" for m in job.MEASURES)
    + " FROM analysed WHERE year IN (1996, 1997) GROUP BY year",
)
def _(t):
    return rounded(job.period_compare(analysed(t), YEARS[:2]), 4)


@query(
    "conditional_avg_ratio",
    TRIPS_SQL
    + """SELECT taxi_type, round(avg(trip_distance), 4) AS avg_trip_distance, round(avg(tip_amount), 4) AS avg_tip_amount,
    round(avg(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount END), 6) AS avg_tip_share
    FROM analysed GROUP BY taxi_type""",
)
def _(t):
    return rounded(rounded(job.tips_by_type(analysed(t)), 6, "avg_tip_share"), 4, "avg_trip_distance", "avg_tip_amount")


@query(
    "group_filtered_not_null",
    TRIPS_SQL
    + """SELECT passenger_count, count(*) AS n_trips, round(avg(trip_distance), 4) AS avg_trip_distance
    FROM analysed WHERE passenger_count IS NOT NULL GROUP BY passenger_count""",
)
def _(t):
    return rounded(job.distance_by_passengers(analysed(t)), 4)


@query("sink_parquet_full", TRIPS_SQL + FEED_TOTALS_SQL.replace("FROM trips", "FROM clean"))
def _(t):
    out = t.scratch("trips-full")
    # one pass from the text to the sink: a copy of the parsed rows would be written for this reader alone
    write_parquet(job.split_valid_invalid(job.conform_feeds(landed_feeds(t)))[0], out, compression="zstd")
    return feed_totals(t.spark.read.parquet(out))


@query(
    "sink_parquet_partitioned",
    TRIPS_SQL
    + """SELECT year, taxi_type, month, count(*) AS n_trips, round(sum(fare_amount), 2) AS fares FROM clean
    GROUP BY year, taxi_type, month""",
)
def _(t):
    out = t.scratch("trips-partitioned")
    write_parquet(job.split_valid_invalid(conformed(t))[0], out, ("year", "taxi_type"))
    rows = t.spark.read.schema(", ".join(f"{c} {kind}" for c, kind in job.TARGET.items())).parquet(out)
    return rows.groupBy("year", "taxi_type", "month").agg(F.count("*").alias("n_trips"), F.round(F.sum("fare_amount"), 2).alias("fares"))


def _long(reports: dict[str, DataFrame]) -> DataFrame:
    """All reports as rows of ``report, label, measure, value``."""
    labels = {
        "validity": [], "by_year": ["year"], "by_year_and_type": ["year", "taxi_type"], "growth": ["year"], "summary": [],
        "period_compare": ["year"], "tips": ["taxi_type"], "passengers": ["passenger_count"], "rejects": ["taxi_type", "column_name"],
    }
    parts = []
    for name, report in reports.items():
        measures = [c for c in report.columns if c not in labels[name]]
        label = F.concat_ws("/", *[F.col(c).cast("string") for c in labels[name]])
        rows = report.select(label.alias("label"), *[F.col(c).cast("double").alias(c) for c in measures])
        parts.append(rows.unpivot("label", measures, "measure", "value").select(F.lit(name).alias("report"), "label", "measure", F.round("value", 4).alias("value")))
    return reduce(DataFrame.unionByName, parts)


def _long_sql() -> str:
    """The same from the numeric columns."""
    averages = {f"avg_{m}": f"avg({m})" for m in job.MEASURES}
    medians = {f"median_{m}": f"quantile_disc({m}, 0.5)" for m in job.MEASURES}
    growth = "SELECT year, n_trips, lag(n_trips) OVER (ORDER BY year) AS p FROM (SELECT year, count(*) AS n_trips FROM analysed GROUP BY year)"
    tables = [
        ("validity", "''", {"all_rows": "count(*)", "valid_rows": "count(*) FILTER (WHERE ok)", "invalid_rows": "count(*) FILTER (WHERE NOT ok)"}, "checked", ""),
        ("by_year", "CAST(year AS VARCHAR)", {"n_trips": "count(*)"}, "analysed", "GROUP BY year"),
        ("by_year_and_type", "year || '/' || taxi_type", {"n_trips": "count(*)"}, "analysed", "GROUP BY year, taxi_type"),
        ("growth", "CAST(year AS VARCHAR)", {"n_trips": "n_trips", "prev_count": "p", "growth_pct": "round((n_trips - p) * 1.0 / p * 100, 2)"}, f"({growth})", ""),
        ("summary", "''", averages | medians, "analysed", ""),
        ("period_compare", "CAST(year AS VARCHAR)", {"n_trips": "count(*)", **averages}, "analysed", "WHERE year IN (1996, 1997) GROUP BY year"),
        ("tips", "taxi_type", {"avg_trip_distance": "avg(trip_distance)", "avg_tip_amount": "avg(tip_amount)", "avg_tip_share": "avg(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount END)"}, "analysed", "GROUP BY taxi_type"),
        ("passengers", "CAST(passenger_count AS VARCHAR)", {"n_trips": "count(*)", "avg_trip_distance": "avg(trip_distance)"}, "analysed", "WHERE passenger_count IS NOT NULL GROUP BY passenger_count"),
    ]
    parts = [
        f"SELECT '{name}' AS report, {label} AS label, '{measure}' AS measure, round(CAST({value} AS DOUBLE), 4) AS value FROM {table} {tail}"
        for name, label, measures, table, tail in tables
        for measure, value in measures.items()
    ]
    columns = [c for c, kind in job.TARGET.items() if kind != "string" and c not in ("year", "month", "extra", "mta_tax", "tolls_amount", "improvement_surcharge")]
    for feed in job.FEED_NAMES:
        present = [c for c in columns if feed != "fhv" or c in ("pickup_datetime", "dropoff_datetime")]
        parts.append(f"SELECT 'rejects', '{feed}/' || c, 'n_rejected', 0.0 FROM (SELECT unnest({present!r}) AS c)")
    return " UNION ALL ".join(parts)


@query("trip_job_reports", TRIPS_SQL + _long_sql())
def _(t):
    """The workload end to end, with its writes; all its reports in long form."""
    return _long(job.run_trip_job(landed_feeds(t), t.scratch("trip-job"), YEARS))
