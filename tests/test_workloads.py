import json

import pytest
from pyspark.sql import functions as F

from tidewater.plans import events, trips
from tidewater.sources.jsonl import EVENT_SCHEMA
from tidewater.streaming.revenue import VERSION, VersionedTable, stream_batch_counts, stream_revenue

EVENTS = [
    ("1", "purchase", 1, 10.0, None, "USD", "2024-01-31T23:59:59+00:00", "web"),
    ("2", "purchase", 1, None, 4.0, "USD", "2024-02-01T00:00:00+00:00", "api"),
    ("3", "purchase", 2, None, None, "EUR", "", "web"),
    ("4", "purchase", 2, 0.0, 9.0, None, None, "web"),
    ("5", "refund", 3, 7.0, None, "EUR", "2024-02-02T00:00:00+00:00", None),
    ("6", "view", 3, 1.0, None, "EUR", "2024-02-02T00:00:00+00:00", "web"),
]


@pytest.fixture
def event_df(spark):
    return spark.createDataFrame(EVENTS, EVENT_SCHEMA)


def test_revenue_keys_and_total(event_df, rows):
    # the purchase without a currency counts in the total only; a price of 0 stays 0
    assert rows(events.revenue_by_key(event_df)) == [("EUR", 1, 0.0, 4), ("USD", 2, 14.0, 4)]
    assert rows(events.revenue_by_key(event_df, "month")) == [("2024-01", 1, 10.0, 4), ("2024-02", 1, 4.0, 4)]


def test_refunds_are_added(event_df, rows):
    assert rows(events.revenue_by_key(event_df, "currency", ["purchase", "refund"])) == [("EUR", 2, 7.0, 5), ("USD", 2, 14.0, 5)]


def test_unknown_strategy(event_df):
    with pytest.raises(ValueError):
        events.revenue_by_key(event_df, "country")


@pytest.fixture
def event_files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    names = EVENT_SCHEMA.names
    for i, e in enumerate(EVENTS):
        record = {n: v for n, v in zip(names, e) if v is not None}
        (folder / f"{i}.json").write_text(json.dumps(record) + "\nbroken\n")
    return folder


def test_stream_equals_batch_and_goes_on_after_restart(spark, event_df, event_files, tmp_path, rows):
    out = str(tmp_path / "out")
    batch = rows(events.revenue_by_key(event_df))
    assert rows(stream_revenue(spark, str(event_files), out, max_files=2)) == batch
    assert rows(stream_revenue(spark, str(event_files), out, max_files=2)) == batch
    (event_files / "late.json").write_text('{"event_type": "purchase", "price": 1.5, "currency": "EUR"}\n')
    assert rows(stream_revenue(spark, str(event_files), out)) == [("EUR", 2, 1.5, 5), ("USD", 2, 14.0, 5)]


def test_stream_writes_changed_keys_only(spark, tmp_path, rows):
    """Each batch writes as many rows as keys it changed; old versions go, and a repeated batch changes nothing."""
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    currencies = [["USD", "EUR"], ["USD"], ["GBP"], ["USD", None], ["EUR"]]
    expected = {}
    for k, found in enumerate(currencies):
        lines = [json.dumps({"event_type": "purchase", "price": k + 1.0, "currency": c}) for c in found]
        (landing / f"{k}.jsonl").write_text("\n".join(lines) + "\n")
        for c in found:
            n, v = expected.get(c, (0, 0.0))
            expected[c] = (n + 1, v + k + 1)
        got = stream_revenue(spark, str(landing), out, compact_after=3)
        total = sum(n for n, _ in expected.values())
        assert rows(got) == sorted((c, n, v, total) for c, (n, v) in expected.items() if c)
        table = VersionedTable(spark, f"{out}/revenue", "revenue_key string, n_events bigint, revenue double", "revenue_key")
        changes, bases = table._versions("changes"), table._versions("base")
        assert len(changes) < 3 and len(bases) <= 2
        if k in changes:
            assert spark.read.parquet(table._path("changes", k)).count() == len(found)
    before = rows(table.read())
    # batch 4 again, as after a crash between its write and its commit; then compaction cut short before its deletions
    again = spark.read.parquet(table._path("changes", 4)).drop(VERSION)
    table.write_changes(spark.createDataFrame(again.collect(), again.schema), 4, 99)
    assert rows(table.read()) == before
    table._newest().write.parquet(table._path("base", 4))
    assert rows(table.read()) == before
    table.compact()
    assert rows(table.read()) == before and table._versions("changes") == [] and len(table._versions("base")) <= 2


def test_stream_batches(spark, event_files, tmp_path):
    counts = stream_batch_counts(spark, str(event_files), str(tmp_path / "out"), "purchase", max_files=4)
    assert [counts.count(), counts.agg(F.sum("n_events")).first()[0]] == [2, 4]


YELLOW = "tpep_pickup_datetime string, tpep_dropoff_datetime string, VendorID string, PULocationID string, trip_distance string, fare_amount string, passenger_count string"


@pytest.fixture
def yellow(spark):
    return spark.createDataFrame(
        [
            ("2018-01-01 10:00:00", "2018-01-01 10:30:00", "1", "7", "1.5", "1,234.50", "2"),
            ("01/02/2018 01:00:00 PM", "1/2/2018 1:00:00 PM", "1", "7", "2", "3", "1"),  # equal times
            ("2018-01-03 00:00:00", "2018-01-04 00:00:00", "2", "7", "0", "5", "1"),  # zero distance
            ("2018-01-03 00:00:00", "2018-01-04 00:00:00", "2", "7", "NaN", "0", None),  # zero fare
            ("not a date", "2019-01-01 00:00:00", "2", "7", None, None, "x"),
        ],
        YELLOW,
    )


def test_conform_feed(yellow):
    conformed = trips.conform_feed(yellow, "yellow")
    assert conformed.columns == list(trips.TARGET)
    assert dict(conformed.dtypes) == trips.TARGET
    first = conformed.filter("fare_amount = 1234.5").first()
    assert (str(first.pickup_datetime), first.year, first.month, first.passenger_count) == ("2018-01-01 10:00:00", 2018, 1, 2)
    assert first.taxi_type == "yellow" and first.sr_flag is None
    same = conformed.filter("fare_amount = 3").first()
    assert same.pickup_datetime == same.dropoff_datetime and same.pickup_datetime.hour == 13
    assert conformed.filter("trip_distance IS NULL").count() == 2  # NaN is missing


def test_fhv_names_differ_by_case(spark):
    feed = spark.createDataFrame([("B1", "1/5/2017 2:03:04 AM", "12", "9", "1")], "dispatching_base_num string, Pickup_DateTime string, PUlocationID string, DOlocationID string, SR_Flag string")
    r = trips.conform_feed(feed, "fhv").first()
    assert (r.vendor_id, r.pickup_location_id, r.dropoff_location_id, r.sr_flag, r.month) == ("B1", "12", "9", "1", 1)
    assert r.fare_amount is None


def test_validity_is_never_null(yellow):
    conformed = trips.conform_feed(yellow, "yellow")
    valid, invalid = trips.split_valid_invalid(conformed)
    assert (valid.count(), invalid.count()) == (2, 3)
    assert tuple(trips.validity_counts(conformed).first()) == (5, 2, 3)
    # a row without a year is clean but not analysed
    assert trips.in_years(valid).count() == 1


def test_parse_rejects_are_counted(yellow):
    lost = {r.column_name: r.n_rejected for r in trips.parse_rejects(yellow, "yellow").collect()}
    assert lost == {"pickup_datetime": 1, "dropoff_datetime": 0, "passenger_count": 1, "trip_distance": 1, "fare_amount": 0}


def test_job_reads_each_feed_once(spark, yellow, tmp_path, plan_of, monkeypatch):
    """The reject counts come from the conforming pass and equal those of a pass of their own."""
    yellow.write.parquet(f"{tmp_path}/feed")
    feed = spark.read.parquet(f"{tmp_path}/feed")
    fhv = spark.createDataFrame([], "dispatching_base_num string, Pickup_DateTime string")
    bare = spark.createDataFrame([("x",)], "VendorID string")
    plans = []
    write = trips.materialise
    monkeypatch.setattr(trips, "materialise", lambda df, label: plans.append(plan_of(df)) or write(df, label))
    reports = trips.run_trip_job({"yellow": feed, "fhv": fhv, "green": bare}, f"{tmp_path}/out")
    got = sorted(map(tuple, reports["rejects"].collect()))
    own = [(name, r.column_name, r.n_rejected) for name, df in (("yellow", feed), ("fhv", fhv)) for r in trips.parse_rejects(df, name).collect()]
    assert got == sorted(own) and ("yellow", "fare_amount", 0) in got and ("fhv", "pickup_datetime", 0) in got
    plans += [plan_of(r) for r in reports.values()]
    scans = [line for p in plans for line in p.split("== Physical Plan ==")[1].splitlines() if "FileScan" in line and f"{tmp_path}/feed" in line]
    assert len(scans) == 1


def test_growth(spark, rows):
    df = spark.createDataFrame([(2017,)] * 4 + [(2018,)] * 5 + [(2019,)] * 3, "year int")
    assert rows(trips.yearly_growth(df)) == [(2017, 4, None, None), (2018, 5, 4, 25.0), (2019, 3, 5, -40.0)]


def test_tip_share_skips_free_rides(spark):
    df = spark.createDataFrame([("fhv", 1.0, 2.0, 10.0), ("fhv", 3.0, 4.0, 0.0), ("fhv", None, 1.0, None)], "taxi_type string, trip_distance double, tip_amount double, fare_amount double")
    assert tuple(trips.tips_by_type(df).first()) == ("fhv", 2.0, 7 / 3, 0.2)


def test_summary_ways_agree(spark):
    df = spark.range(1001).select(*[(F.col("id") * (i + 1)).cast("double").alias(m) for i, m in enumerate(trips.MEASURES)])
    assert trips.summary(df).first().asDict() == trips.summary(df, group_bound=0).first().asDict()
    assert trips.summary(df).first().median_fare_amount == 500.0


def test_whole_job(spark, yellow, tmp_path):
    reports = trips.run_trip_job({"yellow": yellow}, str(tmp_path))
    assert [tuple(r) for r in reports["by_year_and_type"].collect()] == [(2018, "yellow", 1)]
    assert spark.read.parquet(f"{tmp_path}/trips_full").count() == 2
    assert spark.read.parquet(f"{tmp_path}/trips_partitioned").filter("year = 2018").count() == 1


def test_drops_of_many_files_are_one_batch(spark, tmp_path, monkeypatch):
    """a drop is written by as many tasks as read the events, and its batch counts all of its files."""
    from tidewater.plans import queries_events, registry

    registry.load_all()
    events = spark.range(0, 400, 1, 5).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-02 03:04:05' AS ts", "id % 9 AS user_id", "if(id % 8 < 5, 'purchase', 'view') AS event_type", "1D AS value", "'{\"k\": 1}' AS props"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    files = []

    def counted(spark, landing, *a, **b):
        files.append(len(spark.read.text(landing).inputFiles()))
        return stream_batch_counts(spark, landing, *a, **b)

    monkeypatch.setattr(queries_events, "stream_batch_counts", counted)
    found = registry.QUERIES["stream_batch_counts"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [(0, 100), (1, 50), (2, 50), (3, 50)]
    assert files[0] > 1 and files == [files[0] * k for k in (1, 2, 3, 4)]


def test_patterns_are_tried_on_long_enough_text_only(spark):
    """what a pattern cannot read for want of length is not offered to it; the times are those of all patterns in turn."""
    from tidewater.functions.columns import TIMESTAMP_PATTERNS, least_length, parse_timestamp_multi

    assert [least_length(p) for p in TIMESTAMP_PATTERNS] == [19, 22, 19] and least_length("d[ MMM]") == 0
    texts = ["1996-03-04 05:06:07", "03/04/1996 05:06:07 AM", "3/4/1996 5:06:07 PM", "12/24/1996 5:06:07 pm", "12/24/1996 11:06:07 AM", "1/2/96 1:02:03 AM", "", "3/4/1996", "13/13/1996 13:00:00 AM", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(p)) for p in TIMESTAMP_PATTERNS])
    assert df.where(~parse_timestamp_multi(F.col("t")).eqNullSafe(plain)).collect() == []
