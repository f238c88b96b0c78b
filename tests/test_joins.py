import pytest
from pyspark.sql import functions as F

from tidewater.operators import joins, quality


@pytest.fixture
def left(spark):
    return spark.createDataFrame([("a", "Dmitry", 20), ("a", "Sergey", 30), ("b", "Anna", 40), (None, "Nobody", 1)], "label string, name string, age int")


@pytest.fixture
def right(spark):
    return spark.createDataFrame([("a", "Dmitry", 20), ("b", "Sergey", 35), ("c", "Anna", 40), ("b", "Vasiliy", 50), (None, "None", 2)], "label string, name string, age int")


def test_suffixes_and_duplicates_multiply(left, right, rows):
    joined = joins.join_suffixed(left, right, ["label"])
    assert joined.columns == ["label", "name_x", "age_x", "name_y", "age_y"]
    assert rows(joined, "label", "age_x", "age_y") == [("a", 20, 20), ("a", 30, 20), ("b", 40, 35), ("b", 40, 50)]


def test_join_on_names_keeps_both_keys(left, right, rows):
    r = right.select(F.col("name").alias("second"), F.col("age").alias("second_age"))
    assert rows(joins.join_on_names(left, r, "name", "second"), "name", "second", "second_age") == [
        ("Anna", "Anna", 40), ("Dmitry", "Dmitry", 20), ("Sergey", "Sergey", 35)
    ]


@pytest.mark.parametrize("how, n", [("left", 4), ("right", 5), ("full", 6)])
def test_join_on_names_outer(left, right, how, n):
    r = right.select(F.col("name").alias("second"), F.col("age").alias("second_age"))
    joined = joins.join_on_names(left, r, "name", "second", how)
    assert joined.columns == ["label", "name", "age", "second", "second_age"] and joined.count() == n


@pytest.mark.parametrize("validate, fails", [("1:1", True), ("1:m", True), ("m:1", True), ("m:m", False), ("many_to_many", False)])
def test_validated(left, right, validate, fails):
    if fails:
        with pytest.raises(joins.JoinCardinalityError):
            joins.join_validated(left, right, ["label"], validate)
    else:
        assert joins.join_validated(left, right, ["label"], validate).count() == 4


def test_validated_one_sided(left, right, spark):
    unique = spark.createDataFrame([("a", 1), ("b", 2)], "label string, v int")
    assert joins.join_validated(left, unique, ["label"], "m:1").count() == 3
    assert joins.join_validated(unique, left, ["label"], "1:m").count() == 3
    assert joins.join_validated(unique, unique, ["label"], "one_to_one").count() == 2
    with pytest.raises(joins.JoinCardinalityError):
        joins.join_validated(unique, right, ["label"], "1:1")


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_skew_join_equals_plain_join(spark, how, rows):
    """Keys hot on the left, on the right, on both and on none, NULL keys, and keys of one side only."""
    l = [("hl",)] * 40 + [("hr",)] * 2 + [("both",)] * 15 + [("x",), ("only_l",)] + [("hot_only_l",)] * 30 + [(None,)] * 25
    r = [("hl",)] * 3 + [("hr",)] * 50 + [("both",)] * 12 + [("x",), ("only_r",)] + [("hot_only_r",)] * 30 + [(None,)] * 2
    left = spark.createDataFrame([(*k, i) for i, k in enumerate(l)], "k string, i int").repartition(3)
    right = spark.createDataFrame([(*k, i) for i, k in enumerate(r)], "k string, j int").repartition(3)
    expected = rows(left.join(right, ["k"], how))
    got = joins.skew_join(left, right, ["k"], how, hot_rows=10, salts=4)
    assert got.columns == ["k", "i", "j"]
    assert rows(got) == expected
    assert rows(joins.skew_join(left, right, ["k"], how)) == expected


def test_hot_keys(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)] * 20 + [("b", 0.0)] * 3 + [(None, None)] * 15, "k string, d double")
    assert [tuple(k) for k in joins.hot_keys(df, ["k"], 10).collect()] == [("a",)]
    assert [tuple(k) for k in joins.hot_keys(df, ["k", "d"], 10).collect()] == [("a", 1.5)]
    assert joins.hot_keys(df, ["k"], 20).count() == 0 and joins.hot_keys(df.limit(0), ["k"], 0).count() == 0
    # no more than a task's even share
    assert joins.hot_keys(spark.range(1000).select((F.col("id") % 50).alias("k")), ["k"], 10).count() == 0


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("types", [("int", "bigint"), ("string", "int"), ("int", "double"), ("double", "double")])
def test_skew_join_of_different_types(spark, how, types, rows):
    """Hot values that the other type cannot hold, signed zeros, two key columns."""
    l = [1] * 40 + [0, 3, None] * 3
    r = [1] * 30 + [0] * 20 + [2, None] * 4
    left = spark.createDataFrame([(k, 1, i) for i, k in enumerate(l)], "k int, m int, i int").withColumn("k", F.col("k").cast(types[0]))
    right = spark.createDataFrame([(k, 1, i) for i, k in enumerate(r)], "k int, m int, j int").withColumn("k", F.col("k").cast(types[1]))
    if types[1] == "double":
        right = right.withColumn("k", F.when(F.col("k") == 0, -0.0).when(F.col("k") == 2, 1.5).otherwise(F.col("k")))
        right = right.union(right.where("k = 1.5").crossJoin(spark.range(20)).drop("id"))
    for on in (["k"], ["k", "m"]):
        expected = rows(left.join(right, on, how), *[F.col("k").cast("double").alias("k"), "i", "j"])
        assert rows(joins.skew_join(left, right, on, how, hot_rows=10, salts=4), *[F.col("k").cast("double").alias("k"), "i", "j"]) == expected


@pytest.fixture
def jobs(spark):
    """How many jobs a call takes."""

    def run(call):
        group = f"jobs-{id(call)}"
        spark.sparkContext.setJobGroup(group, "")
        out = call()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    yield run
    spark.sparkContext.setJobGroup("", "")


def test_joins_start_nothing_themselves(spark, jobs, tmp_path, plan_of):
    """Building an inner or outer join of tables runs no job; the inner one reads each side once, the outer one twice."""
    spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).write.parquet(f"{tmp_path}/l")
    spark.range(3000).select((F.col("id") % 3).alias("k")).write.parquet(f"{tmp_path}/r")
    left, right = (spark.read.parquet(f"{tmp_path}/{s}") for s in "lr")
    for how, scans in (("inner", 2), ("left", 3), ("right", 3), ("full", 4)):
        joined, n = jobs(lambda how=how: joins.skew_join(left, right, ["k"], how, hot_rows=10))
        assert n == 0, how
        physical = plan_of(joined).split("== Physical Plan ==")[1]
        # the hot keys are one frame, broadcast to both sides
        assert physical.count("FileScan parquet") <= scans + (scans - 2 if how != "inner" else 0), how
    for call in (joins.semi, joins.anti):
        lookup, n = jobs(lambda call=call: call(left, right, "k", "k"))
        assert n == 0 and plan_of(lookup).split("== Physical Plan ==")[1].count("FileScan parquet") == 2


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_equal_rows_of_a_hot_key_are_spread(spark, how, tmp_path):
    """A side of one column: its rows of a key differ in nothing but their place."""
    spark.createDataFrame([(7,)] * 600 + [(1,)], "k int").coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    few = spark.createDataFrame([(7, "a"), (8, "b")], "k int, v string")
    sides = {"left": (few, one), "right": (one, few), "full": (one, few)}[how]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = joins.skew_join(*sides, ["k"], how, hot_rows=100, salts=16)
        held = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in held) == 600 and len(held) > 1 and max(r["count"] for r in held) < 500


def test_semi_anti(spark, rows):
    df = spark.createDataFrame([(1, "p"), (1, "q"), (1, "r"), (2, "s"), (None, "t"), (3, "u")], "k int, v string")
    other = spark.createDataFrame([(1,), (1,), (3,), (None,), (9,)], "o int")
    assert rows(joins.semi(df, other, "k", "o"), "v") == [("p",), ("q",), ("r",), ("u",)]
    assert rows(joins.anti(df, other, "k", "o"), "v") == [("s",), ("t",)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_equals_plain_join(spark, how, rows):
    keys = [1] * 20 + [2] * 30 + [3] * 2 + [None] * 15 + [9]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(3)
    lookup = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d"), (None, "n")], "id int, v string")
    expected = rows(df.join(lookup, F.col("k") == F.col("id"), how).drop("id"))
    assert rows(joins.lookup_join(df, lookup, "k", "id", how)) == expected


def test_not_in(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    known = spark.createDataFrame([(1,)], "o int")
    assert rows(joins.not_in(df, known, "k", "o")) == [(2,)]
    assert rows(joins.not_in(df, known.union(spark.createDataFrame([(None,)], "o int")), "k", "o")) == []
    assert rows(joins.not_in(df, known.limit(0), "k", "o")) == [(1,), (2,), (None,)]


def test_align_add(spark, rows):
    a = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "l string, v int")
    b = spark.createDataFrame([("b", 10), ("c", 20), ("d", 30)], "l string, v int")
    assert rows(joins.align_add(a, b, "l", "v")) == [("a", None), ("b", 12), ("c", 23), ("d", None)]


def test_concat_columns(spark):
    whole = spark.range(150).withColumnRenamed("id", "label").withColumn("v", F.col("label") * 2)
    part = whole.filter("label < 50")
    outer = joins.concat_columns(whole, part, "label", "full")
    assert outer.columns == ["label", "v_x", "v_y"] and outer.count() == 150
    assert outer.filter("v_y IS NULL").count() == 100
    assert joins.concat_columns(whole, part, "label", "inner").count() == 50


def test_scalar(spark, rows):
    df = spark.createDataFrame([(1,), (3,)], "v int")
    assert rows(joins.with_scalar(df, df, F.avg("v"), "m")) == [(1, 2.0), (3, 2.0)]


# ---- integrity rules ----


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([("A",), ("B",), ("C",)], "clsid string")


@pytest.fixture
def child(spark):
    return spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, None), (5, "Z")], "cid int, cls string")


def test_unique_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert tuple(quality.check_unique_key(df, ["a", "b"]).first()) == ("a,b", 3, 2, 1, "has duplicates")
    assert quality.check_unique_key(df.distinct(), ["a", "b"]).first().verdict == "unique"
    assert tuple(quality.check_unique_key(df.limit(0), ["a"]).first()) == ("a", 0, 0, 0, "unique")


def test_foreign_key(parent, child, rows):
    assert rows(quality.check_foreign_key(child, parent, "cls", "clsid")) == [(5, "Z")]
    accepted, rejected = quality.insert_with_fk_gate(child, parent, "cls", "clsid")
    assert rows(accepted, "cid") == [(1,), (2,), (3,), (4,)]
    assert rows(rejected) == [(5, "Z", "cls has no parent")]


def test_delete_rules(parent, child, rows):
    free, used = quality.delete_restrict(parent, child, "clsid", "cls")
    assert (rows(free), rows(used)) == ([("C",)], [("A",), ("B",)])
    deleted = parent.filter("clsid = 'A'")
    assert rows(quality.delete_cascade(child, deleted, "cls", "clsid"), "cid") == [(3,), (4,), (5,)]
    assert rows(quality.delete_set_null(child, deleted, "cls", "clsid")) == [(1, None), (2, None), (3, "B"), (4, None), (5, "Z")]


def test_update_key(spark, parent, child, rows):
    changes = spark.createDataFrame([("A", "AA")], "old_key string, new_key string")
    with pytest.raises(quality.ReferencedKeyError):
        quality.update_key(parent, child, changes, "clsid", "cls", "restrict")
    p, c = quality.update_key(parent, child, changes, "clsid", "cls", "cascade")
    assert rows(p) == [("AA",), ("B",), ("C",)]
    assert rows(c) == [(1, "AA"), (2, "AA"), (3, "B"), (4, None), (5, "Z")]
    free = spark.createDataFrame([("C", "D")], "old_key string, new_key string")
    assert rows(quality.update_key(parent, child, free, "clsid", "cls", "restrict")[0]) == [("A",), ("B",), ("D",)]


def test_row_rules(spark, rows):
    df = spark.createDataFrame([(1, 1890, "x"), (2, None, "7"), (3, 1950, None)], "id int, year int, t string")
    assert rows(quality.check_predicates(df, {"year": F.col("year") > 1900}), "id", "violations") == [(1, "year")]
    assert rows(quality.check_not_null(df, ["year", "t"])) == [("t", 1), ("year", 1)]
    assert rows(quality.check_type(df, "t", "int"), "id") == [(1,)]
    assert rows(quality.apply_defaults(df, {"year": 2000, "t": "-", "src": "web"})) == [
        (1, 1890, "x", "web"), (2, 2000, "7", "web"), (3, 1950, "-", "web")
    ]


def test_surrogate_key(spark, rows):
    batch = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    assert rows(quality.surrogate_key(batch, ["name"], "id")) == [("a", 1), ("b", 2), ("c", 3)]
    existing = spark.createDataFrame([(7,), (4,)], "id int")
    assert rows(quality.surrogate_key(batch, ["name"], "id", existing)) == [("a", 8), ("b", 9), ("c", 10)]


def test_normalise(spark, rows):
    wide = spark.createDataFrame([(1, "D", 5, "a"), (2, "D", 5, "a"), (3, "E", 4, "m")], "cid int, cls string, capacity int, gear string")
    fact, dim = quality.normalise_split(wide, ["cls"], ["capacity", "gear"])
    assert (fact.columns, dim.count()) == (["cid", "cls"], 2)
    assert rows(fact.join(dim, "cls"), *wide.columns) == rows(wide)
    with pytest.raises(ValueError):
        quality.normalise_split(wide.withColumn("capacity", F.col("cid")), ["cls"], ["capacity"])


def test_salts_do_not_depend_on_the_order_of_arrival(spark, plan_of):
    """A task that runs again may see its rows in another order; each must go where it went before."""
    left = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, w string")
    got = []
    for shuffled in (left, left.repartition(3, "v"), left.orderBy(F.desc("v"))):
        joined = joins.skew_join(shuffled, right, ["k"], "left", hot_rows=100, salts=4)
        assert "monotonically_increasing_id" not in plan_of(joined)
        got.append(sorted((r.k, r.v, r.w) for r in joined.collect() if r.w))
    assert got[0] == got[1] == got[2] and len(got[0]) == 1334


def test_positions_number_a_written_table(spark, plan_of):
    from tidewater.operators import ordering

    shuffled = spark.range(100).repartition(3, "id")
    physical = plan_of(ordering.sort_rows(shuffled, (F.col("id") % 5).asc())).split("== Physical Plan ==")[1]
    below = physical[physical.index("monotonically_increasing_id") :]
    assert "FileScan parquet" in below and "hashpartitioning(id" not in below


def test_key_changes_that_clash_are_refused(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1,)], "f int")
    for changes in ([(1, 2)], [(1, 7), (1, 8)], [(1, 9), (2, 9)]):
        with pytest.raises(ValueError):
            quality.update_key(parent, child, spark.createDataFrame(changes, "old_key int, new_key int"), "k", "f", "cascade")
    moved, _ = quality.update_key(parent, child, spark.createDataFrame([(1, 2), (2, 1)], "old_key int, new_key int"), "k", "f", "cascade")
    assert sorted(r.k for r in moved.collect()) == [1, 2]


def test_normalising_loses_no_row(spark, rows):
    df = spark.createDataFrame([(1, "a", 10), (2, None, 20), (3, "a", 10), (4, None, 20)], "id int, d string, v int")
    fact, dimension = quality.normalise_split(df, ["d"], ["v"])
    assert rows(quality.normalise_join(fact, dimension, ["d"]), "id", "d", "v") == rows(df, "id", "d", "v")


def test_branches_come_from_one_join(spark, jobs, plan_of, tmp_path, rows):
    """Both sides of a rule read what one join wrote, each its own folder; empty branches and empty tables stay typed."""
    from tidewater.operators import filters

    spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 7).alias("k")).write.parquet(f"{tmp_path}/t")
    df, other = spark.read.parquet(f"{tmp_path}/t"), spark.createDataFrame([(1,), (1,), (3,), (None,)], "o long")
    (used, free), _ = jobs(lambda: joins.semi_and_anti(df, other, "k", "o"))
    assert rows(used, "id") == rows(joins.semi(df, other, "k", "o"), "id") and rows(free, "id") == rows(joins.anti(df, other, "k", "o"), "id")
    for branch in (used, free):
        physical = plan_of(branch).split("== Physical Plan ==")[1]
        assert branch.columns == ["id", "k"] and "Join" not in physical and f"{tmp_path}/t" not in physical
        assert "PartitionFilters: [" in physical and "tidewater_branch" in physical.split("PartitionFilters: [")[1].split("]")[0]
    held, rest = filters.route(df, F.col("id") >= 0)
    assert held.count() == 100 and rest.count() == 0 and rest.schema == df.schema
    for part in filters.route(df.limit(0), F.col("k") > 0):
        assert part.count() == 0 and part.columns == ["id", "k"]
