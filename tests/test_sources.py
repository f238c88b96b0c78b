import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources import files, generate
from tidewater.sources.jsonl import EVENT_SCHEMA, read_jsonl_strict, read_jsonl_tolerant

GOOD = {"event_id": "a", "event_type": "purchase", "user_id": 1, "price": 2.5, "currency": "USD", "ts": "2024-01-31T23:30:00-05:00", "source": "web"}


@pytest.fixture
def landing(tmp_path):
    def write(lines):
        (tmp_path / "events.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(tmp_path)

    return write


def test_tolerant_keeps_every_line(spark, landing):
    lines = [json.dumps(GOOD), "not json", "", "5", json.dumps({"event_id": "b"}), json.dumps({**GOOD, "price": None, "amount": 3.0})]
    good, rejects = read_jsonl_tolerant(spark, landing(lines))
    assert sorted(r.price or -1 for r in good.collect()) == [-1, 2.5]
    assert sorted((r.line, r.reject_reason) for r in rejects.collect()) == [
        ("", "blank line"),
        ("5", "not a JSON object of this schema"),
        ("not json", "not a JSON object of this schema"),
        ('{"event_id": "b"}', "required field missing"),
    ]


def test_tolerant_equals_strict_on_clean_input(spark, landing, rows):
    path = landing([json.dumps(GOOD), json.dumps({**GOOD, "event_id": "b", "currency": None})])
    good, rejects = read_jsonl_tolerant(spark, path)
    assert rows(good) == rows(read_jsonl_strict(spark, path)) and rejects.isEmpty()


def test_strict_fails_on_a_bad_line(spark, landing):
    with pytest.raises(Exception, match="MALFORMED"):
        read_jsonl_strict(spark, landing([json.dumps(GOOD), "{broken"])).collect()


def test_csv_null_markers(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id;v\n1;NA\n2;-\n3;4.5\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    df = files.read_csv_options(spark, str(tmp_path), schema, sep=";", null_values=("NA", "-"))
    assert rows(df) == [(1, None), (2, None), (3, 4.5)]


def test_landing_tags_and_skips(spark, tmp_path, rows):
    folder = tmp_path / "with blank green"  # the folder's name sets no tag
    folder.mkdir()
    headers = {"YELLOW_2019.csv": "VendorID,PULocationID", "green.csv": "PULocationID,VendorID", "x_for_hire_vehicle.csv": "base", "fhv2.csv": "base", "bus.csv": "a"}
    for name, header in headers.items():
        (folder / name).write_text(header + "\n" + ",".join(c[:2] for c in header.split(",")) + "\n")
    feeds = files.read_landing_tagged(spark, str(folder))
    assert {tag: df.count() for tag, df in feeds.items()} == {"fhv": 2, "green": 1, "yellow": 1}
    assert rows(feeds["yellow"]) == [("Ve", "PU", "yellow")] and rows(feeds["green"]) == [("PU", "Ve", "green")]


def test_files_of_different_headers(spark, tmp_path, rows):
    """Columns in another order, missing, new, in another case, quoted; an empty file; a name with a blank and a per cent sign."""
    contents = {
        "a.csv": "x,y\n1,2\n", "b.csv": "y,x\n20,10\n", "c.csv": '"X","z, z"\n100,q\n', "d 1%20.csv": "\ufeffx,y\n3,4\n5,6\n", "e.csv": "", "f.csv": "y\n",
    }
    for name, text in contents.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    df = files.read_csv_text(spark, f"{tmp_path}/*.csv")
    assert df.columns == ["x", "y", "z, z"]
    assert rows(df) == [("1", "2", None), ("10", "20", None), ("100", None, "q"), ("3", "4", None), ("5", "6", None)]
    headers = files.csv_headers(spark, f"{tmp_path}/*.csv")
    assert [len(v) for v in headers.values()] == [2, 1, 1, 1]


def test_headers_are_read_without_the_files(spark, tmp_path):
    """One task per file, each of which stops after its first line: a broken text further down is not met."""
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text(f"a,b{k % 2}\n" + "1,2\n" * 200_000)
    group = "headers"
    spark.sparkContext.setJobGroup(group, "")
    headers = files.csv_headers(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("", "")
    assert tasks == [5] and {h: len(p) for h, p in headers.items()} == {("a", "b0"): 3, ("a", "b1"): 2}


def test_feeds_with_changing_headers(spark, tmp_path, rows):
    (tmp_path / "yellow_1.csv").write_text("VendorID,PULocationID\n1,7\n")
    (tmp_path / "yellow_2.csv").write_text("PULocationID,tip,vendorid\n8,0.5,2\n")
    feed = files.read_landing_tagged(spark, str(tmp_path))["yellow"]
    assert feed.columns == ["VendorID", "PULocationID", "tip", "source_tag"]
    assert rows(feed) == [("1", "7", None, "yellow"), ("2", "8", "0.5", "yellow")]


def test_repeated_and_missing_names(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("x,,X,y\n1,2,3,4\n")
    df = files.read_csv_text(spark, str(tmp_path / "a.csv"))
    assert df.columns == spark.read.option("header", True).csv(str(tmp_path / "a.csv")).columns and rows(df) == [("1", "2", "3", "4")]


def test_partitioned_sink_prunes(spark, tmp_path, plan_of):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 2 + 2017).cast("int").alias("year"), F.lit("fhv").alias("taxi_type"))
    files.write_parquet(df, str(tmp_path / "out"), ("year", "taxi_type"))
    back = spark.read.parquet(str(tmp_path / "out")).filter("year = 2017")
    assert back.count() == 50
    assert "PartitionFilters: [isnotnull(year" in plan_of(back)


def test_generated_events_do_not_depend_on_partitions(spark, rows):
    one = generate.events_for_ids(spark.range(0, 500, 1, 1), "id", 3, 1_735_689_600)
    many = generate.events_for_ids(spark.range(0, 500, 1, 7), "id", 3, 1_735_689_600)
    assert rows(one) == rows(many)


def test_generated_event_mix(spark):
    events = generate.generate_events(spark, 40_000, seed=5)
    shares = {r.event_type: r["count"] / 40_000 for r in events.groupBy("event_type").count().collect()}
    for name, share in generate.EVENT_SHARES:
        assert abs(shares[name] - share) < 0.01
    assert events.filter("price <> 0 AND event_type NOT IN ('purchase', 'refund')").isEmpty()
    prices = events.filter("event_type = 'purchase'").agg(F.min("price"), F.max("price")).first()
    assert 5 <= prices[0] < 6 and 499 < prices[1] <= 500
    assert events.agg(F.countDistinct("event_id")).first()[0] == 40_000


def test_random_columns_moments(spark):
    df = generate.random_columns(spark.range(20_000), "id", 1, 10.0, 2.0, 5, 8)
    r = df.agg(F.avg("uniform"), F.avg("std_normal"), F.stddev("std_normal"), F.avg("normal"), F.stddev("normal"), F.min("integer"), F.max("integer")).first()
    assert abs(r[0] - 0.5) < 0.01 and abs(r[1]) < 0.03 and abs(r[2] - 1) < 0.03
    assert abs(r[3] - 10) < 0.06 and abs(r[4] - 2) < 0.06 and (r[5], r[6]) == (5, 7)


def test_headers_take_a_bounded_part_of_a_file(spark, tmp_path):
    """F2, F3, F4, F5, F6, F8: the rows that a header's task reads do not grow with its file."""
    (tmp_path / "a.csv").write_text("a,b\n" + "1,2\n" * 400_000)
    spark.sparkContext.setJobGroup("bounded", "")
    assert list(files.csv_headers(spark, str(tmp_path))) == [("a", "b")]
    spark.sparkContext.setJobGroup("", "")
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = [s for j in tracker.getJobIdsForGroup("bounded") for s in tracker.getJobInfo(j).stageIds]
    assert sum(store.lastStageAttempt(s).inputRecords() for s in stages) < 100_000


LINES = (
    "id AS l_orderkey, id % 50 AS l_partkey, id % 7 AS l_suppkey, CAST(id % 7 + 1 AS INT) AS l_linenumber, 5D AS l_quantity, 10.5D AS l_extendedprice, 0.1D AS l_discount, "
    "0.2D AS l_tax, element_at(array('A', 'R', 'N'), CAST(id % 3 AS INT) + 1) AS l_returnflag, 'O' AS l_linestatus, timestamp_ntz'1996-03-04 05:06:07' AS l_shipdate"
)


def test_drops_are_written_by_as_many_tasks_as_read(spark, tmp_path, monkeypatch):
    """no file of a drop gets a fixed share of the table."""
    from tidewater.plans import registry

    spark.range(0, 600, 1, 6).createOrReplaceTempView("some_ids")
    spark.sql(f"SELECT {LINES} FROM some_ids").write.parquet(f"{tmp_path}/lineitem.parquet")
    registry.load_all()
    parts, write = [], files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path, *a: (parts.append(df.rdd.getNumPartitions()), write(df, path, *a)))
    found = registry.QUERIES["scan_csv_text_glob"](spark, str(tmp_path)).collect()
    assert sorted((r.l_returnflag, r.n_rows, r.price_sum) for r in found) == [("A", 200, 2100.0), ("N", 200, 2100.0), ("R", 200, 2100.0)]
    assert parts == [spark.read.parquet(f"{tmp_path}/lineitem.parquet").rdd.getNumPartitions()] * 2 and parts[0] > 2


def test_full_sink_needs_no_copy_of_the_parsed_rows(spark, tmp_path):
    """from the text to the sink in one pass."""
    from tidewater.plans import queries_trips, registry

    spark.range(0, 60, 1, 2).createOrReplaceTempView("some_ids")
    spark.sql(f"SELECT {LINES} FROM some_ids").write.parquet(f"{tmp_path}/lineitem.parquet")
    registry.load_all()
    before = set(queries_trips._written)
    found = registry.QUERIES["sink_parquet_full"](spark, str(tmp_path)).collect()
    # line number 7 ends before it begins
    assert sum(r.n_rows for r in found) == sum(i % 7 != 6 for i in range(60))
    assert {key[2] for key in set(queries_trips._written) - before} == {"trip-feeds"}
