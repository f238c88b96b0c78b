import datetime
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions import columns as fn
from tidewater.operators import aggregates, apply, filters, joins, missing, ordering, project, reshape, sets
from tidewater.operators import quantiles as quantile_steps
from tidewater.operators.quantiles import quantiles


# ---- positions and order ----


@pytest.mark.parametrize("partitions", [1, 8])
def test_positions(spark, partitions):
    df = spark.range(0, 1000, 1, partitions).select(((F.col("id") * 7919) % 1000).alias("k"))
    assert [tuple(r) for r in ordering.with_positions(df, ["k"]).orderBy("pos").collect()] == [(i, i) for i in range(1000)]


def test_positions_with_one_value_only(spark):
    df = spark.range(0, 500, 1, 5).select(F.lit(1).alias("k"))
    placed = ordering.with_positions(df, ["k"], start=1)
    assert sorted(r.pos for r in placed.collect()) == list(range(1, 501))
    # copies are spread over tasks
    assert ordering.bucketed(df, ["k"]).groupBy(ordering.BUCKET).count().agg(F.max("count")).first()[0] < 250


def test_positions_write_no_copy(spark, tmp_path, monkeypatch):
    """Nothing as wide or as long as the table is written for an order, unique or not; positions do not depend on passes."""
    path = f"{tmp_path}/t"
    spark.range(0, 4000, 1, 6).selectExpr("(id * 7919) % 4000 AS k", "id % 3 AS dup", "repeat('x', 200) AS wide").write.parquet(path)
    df = spark.read.parquet(path)
    written = []
    write = ordering.materialise
    monkeypatch.setattr(ordering, "materialise", lambda df, label: written.append((label, df.count(), df.columns)) or write(df, label))
    for order in (["k"], ["dup"]):
        placed = ordering.with_positions(df, order).select("pos", *order).orderBy("pos").collect()
        assert [r.pos for r in placed] == list(range(4000)) and [r[1] for r in placed] == sorted(r[1] for r in placed)
    ordering.ffill(df, ["k"], ["wide"]).count()
    assert written == []


@pytest.mark.parametrize("descending", [False, True])
def test_positions_by_several_columns(spark, descending):
    """NULLs, NaN, text and signs as keys; against one global window."""
    draw = np.random.default_rng(8)
    values = [None, float("nan"), -0.0, 1.5, -3.0]
    data = [(values[draw.integers(5)], [None, "b", "a", "é"][draw.integers(4)], int(i)) for i in draw.permutation(600)]
    df = spark.createDataFrame(data, "x double, s string, i int").repartition(5)
    asc = lambda c: F.desc_nulls_last(c) if descending else F.asc_nulls_first(c)
    expected = df.withColumn("p", F.row_number().over(Window.orderBy(asc("x"), asc("s"), asc("i"))) - 1).select("i", "p").collect()
    got = ordering.with_positions(df, ["x", "s", "i"], descending=descending).select("i", "pos").collect()
    assert {(r.i, r.p) for r in expected} == {(r.i, r.pos) for r in got}


def test_reset_index(spark, rows):
    df = spark.createDataFrame([(2,), (1,)], "v int")
    assert rows(ordering.concat_reset_index([df, df], ["v"]), "index", "v") == [(0, 1), (1, 2), (2, 1), (3, 2)]


def test_slices(spark, rows):
    df = spark.range(10).withColumnRenamed("id", "v")
    assert rows(ordering.slice_positions(df, ["v"], 2, 9, 3), "v") == [(2,), (5,), (8,)]
    assert [r.v for r in ordering.slice_positions(df, ["v"], step=-4).orderBy("pos").collect()] == [9, 5, 1]
    assert rows(ordering.slice_labels(df, "v", 3, 5)) == [(3,), (4,), (5,)]
    with pytest.raises(ValueError):
        ordering.slice_positions(df, ["v"], step=0)


def test_head_tail_sample(spark, rows):
    df = spark.range(20).withColumnRenamed("id", "v")
    assert rows(ordering.head(df, ["v"], 2)) == [(0,), (1,)] and rows(ordering.tail(df, ["v"], 2)) == [(18,), (19,)]
    picked = rows(ordering.sample_rows(df, "v", 5, seed=1))
    assert len(set(picked)) == 5 and picked == rows(ordering.sample_rows(df.repartition(6), "v", 5, seed=1))
    assert ordering.sample_fraction(df, 0.5, 1).count() <= 20


def test_sort_rows_spreads_ties(spark):
    df = spark.range(0, 400, 1, 4).select("id", F.lit(0).alias("k"))
    done = ordering.sort_rows(df, F.col("k").asc())
    assert [r.id for r in done.collect()] == list(range(400))


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("direction", ["ffill", "bfill"])
def test_fill_against_pandas(spark, keys, direction):
    """Long NULL runs cover whole range partitions; groups begin and end inside partitions."""
    rng = np.random.default_rng(2)
    n = 400
    pdf = pd.DataFrame({"g": np.repeat(["a", "b", "c", None], [250, 100, 1, 49]), "o": rng.permutation(n), "v": rng.random(n), "w": [f"s{i}" for i in range(n)]})
    pdf.loc[rng.random(n) < 0.5, "v"] = None
    pdf.loc[(pdf.o > 60) & (pdf.o < 330), "v"] = None
    pdf.loc[pdf.o < 30, "w"] = None
    pdf.loc[pdf.o > 370, "w"] = None
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)], "g string, o int, v double, w string").repartition(5)
    filled = getattr(ordering, direction)(df, ["o"], ["v", "w"], keys)
    got = filled.toPandas().sort_values("o").reset_index(drop=True)
    base = pdf.sort_values("o").reset_index(drop=True)
    expected = base.copy()
    source = base.groupby(base.g.fillna("?"))[["v", "w"]] if keys else base[["v", "w"]]
    expected[["v", "w"]] = getattr(source, direction)()
    assert got.o.tolist() == expected.o.tolist()
    assert np.allclose(got.v.astype(float), expected.v.astype(float), equal_nan=True)
    assert got.w.where(got.w.notna(), None).tolist() == expected.w.where(expected.w.notna(), None).tolist()


def test_fill_keeps_types(spark):
    df = spark.createDataFrame([(1, 2**60 + 1, datetime.datetime(2024, 1, 1, 0, 0, 0, 1)), (2, None, None)], "o int, v bigint, t timestamp_ntz")
    assert tuple(ordering.ffill(df, ["o"], ["v", "t"]).filter("o = 2").first()) == (2, 2**60 + 1, datetime.datetime(2024, 1, 1, 0, 0, 0, 1))


@pytest.mark.parametrize("bound", [0, 10**9])
def test_dense_rank(spark, bound, rows):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("a", 5.0), ("a", 7.0), ("a", None), ("b", 1.0), (None, 2.0), (None, 1.0)], "g string, v double")
    assert rows(ordering.dense_rank_in_group(df, ["g"], "v", group_bound=bound)) == [
        ("a", 5.0, 1), ("a", 5.0, 1), ("a", 5.0, 1), ("a", 7.0, 2), ("a", None, None), ("b", 1.0, 1), (None, 1.0, 1), (None, 2.0, 2)
    ]


def test_dense_rank_routes_by_size(spark, plan_of):
    """One large group and many small ones: the first by buckets, the others by a window, in one plan."""
    data = [("large", i % 700) for i in range(3000)] + [(f"g{i % 200}", i % 5) for i in range(1000)] + [(None, 1), (None, None)]
    df = spark.createDataFrame(data, "g string, v int").repartition(4)
    ranked = ordering.dense_rank_in_group(df, ["g"], "v", group_bound=1000)
    by_window = F.when(F.col("v").isNotNull(), F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last())))
    assert sorted(map(str, ranked.collect())) == sorted(map(str, df.withColumn("rank", by_window).collect()))
    large = joins.hot_hashes(df, ["g"], 1000)
    assert [r[0] for r in large.collect()] == [df.select(F.xxhash64(F.lit("large"))).first()[0]]
    physical = plan_of(ranked).split("== Physical Plan ==")[1]
    assert "dense_rank(" in physical and "row_number()" in physical and physical.count("approx_top_k") > 0


def test_fills_stay_in_the_engine(spark, plan_of):
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 7 = 0 THEN id END AS v")
    for fill in (ordering.ffill, ordering.bfill):
        assert not re.search("Python|Arrow|Pandas", plan_of(fill(df, ["id"], ["v"])))


# ---- statistics ----


@pytest.fixture
def measured(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 3000, p=[0.9, 0.08, 0.02]), "x": rng.normal(size=3000), "y": rng.integers(0, 4, 3000).astype(float)})
    pdf.loc[rng.random(3000) < 0.1, "x"] = np.nan
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("bound, brackets", [(10**9, 1000), (0, 1000), (0, 0)])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_quantiles_exact(measured, bound, brackets, keys):
    pdf, df = measured
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "hi": 1.0}
    got = quantiles(df, ["x", "y"], probs, keys, group_bound=bound, bracket_groups=brackets).toPandas()
    for _, r in got.iterrows():
        part = pdf if not keys else pdf[pdf.g == r.g]
        for c in ("x", "y"):
            assert np.allclose([r[f"{c}_{p}"] for p in probs], part[c].quantile(list(probs.values())))
    assert len(got) == (3 if keys else 1)


@pytest.mark.parametrize("bound", [10**9, 0])
def test_discrete_median(spark, bound):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double")
    assert quantiles(df, ["v"], {"m": 0.5}, discrete=True, group_bound=bound).first()[0] == 2.0


@pytest.mark.parametrize("bound, brackets", [(10**9, 1000), (0, 1000), (0, 0)])
def test_quantiles_keep_their_type(spark, bound, brackets):
    """Longs beyond 2^53, decimals and dates beside each other; NULL keys are a group."""
    far = 2**53
    df = spark.range(501).selectExpr(
        f"{far} + id AS n", "CAST(id AS decimal(20,2)) / 4 AS d", "date_add(date'2020-01-01', CAST(id AS int)) AS day", "CAST(id AS float) AS x", "CASE WHEN id < 500 THEN 'g' END AS g"
    ).withColumn("d", F.col("d").cast("decimal(30,2)"))
    columns = ["n", "d", "day", "x"]
    got = quantiles(df, columns, {"m": 0.5}, ["g"], discrete=True, group_bound=bound, bracket_groups=brackets)
    assert dict(got.dtypes) == {"g": "string", "n_m": "bigint", "d_m": "decimal(30,2)", "day_m": "date", "x_m": "float"}
    values = {r.g: (r.n_m, str(r.d_m), str(r.day_m), r.x_m) for r in got.collect()}
    assert values == {"g": (far + 249, "62.25", "2020-09-06", 249.0), None: (far + 500, "125.00", "2021-05-15", 500.0)}
    wide = spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "n long")
    assert quantiles(wide, ["n"], {"m": 0.5}, group_bound=bound, bracket_groups=brackets).first()[0] == 0.0


def test_two_scans(spark, tmp_path, plan_of, monkeypatch):
    """Aggregates and quartiles of large groups read the input twice, whatever is written in between."""
    path = f"{tmp_path}/t"
    spark.range(5000).selectExpr("id % 3 AS g", "CAST(id AS double) AS v").write.parquet(path)
    plans = []
    write = quantile_steps.materialise
    monkeypatch.setattr(quantile_steps, "materialise", lambda df, label: plans.append(plan_of(df)) or write(df, label))
    for keys in (["g"], []):
        plans.clear()
        report = aggregates.describe(spark.read.parquet(path), ["v"], keys, group_bound=0)
        plans.append(plan_of(report))
        scans = [line for p in plans for line in p.split("== Physical Plan ==")[1].splitlines() if "FileScan" in line and path in line]
        assert len(scans) == 2 and report.count() == (3 if keys else 1)


def test_nan_is_missing_in_statistics(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", float("nan"), 2), ("a", 3.0, None)], "g string, x double, k int")
    r = aggregates.column_stats(df, ["x", "k"]).first()
    assert (r.x_mean, r.x_var, r.k_mean) == (2.0, 2.0, 1.5)
    assert aggregates.group_means(df, ["g"]).first().x_mean == 2.0


def test_empty_quantiles(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert quantiles(df, ["v"], {"m": 0.5}).first()[0] is None
    assert quantiles(df, ["v"], {"m": 0.5}, ["g"]).count() == 0


def test_describe_against_pandas(measured):
    pdf, df = measured
    got = aggregates.describe(df.withColumn("x", fn.nan_to_null(F.col("x"))), ["x"]).first()
    expected = pdf.x.describe()
    for name, label in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert np.isclose(got[f"x_{name}"], expected[label])


def test_groups_leave_null_keys_out(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 9)], "g string, v int")
    assert rows(aggregates.group_agg(df, ["g"], {"v": ["max", "mean", "median"]})) == [("a", 3, 2.0, 2.0)]
    assert rows(aggregates.value_counts(df, "g")) == [("a", 2)]
    assert rows(aggregates.group_means(df, ["g"])) == [("a", 2.0)]


def test_string_agg(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "z", 1)], "k int, s string, o int")
    assert rows(aggregates.string_agg_ordered(df, ["k"], "s", "o")) == [(1, "a, b"), (2, "z")]
    with pytest.raises(aggregates.GroupTooLargeError):
        aggregates.string_agg_ordered(df, ["k"], "s", "o", max_chars=4)


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert tuple(aggregates.profile_relation(df, "t").first()) == ("t", 2, 2, "t(a, b)", 2, 1)


# ---- missing data ----


@pytest.fixture
def holes(spark):
    return spark.createDataFrame([(1, None, "x"), (2, 2.0, None), (3, 3.0, "z")], "id int, v double, s string")


def test_missing(holes, rows):
    assert tuple(missing.null_counts(holes).first()) == (0, 1, 1, 2)
    assert rows(missing.null_mask(holes), "v") == [(False,), (False,), (True,)]
    assert rows(missing.drop_rows_with_null(holes)) == [(3, 3.0, "z")]
    assert missing.drop_columns_with_null(holes).columns == ["id"]
    assert rows(missing.fill_scalar(holes, 0), "id", "v") == [(1, 0.0), (2, 2.0), (3, 3.0)]
    assert rows(missing.fill_by_column(holes, {"v": 9.0, "s": "-"})) == [(1, 9.0, "x"), (2, 2.0, "-"), (3, 3.0, "z")]
    assert rows(missing.update_cells(holes, F.col("v") > 2, {"s": "new"})) == [(1, None, "x"), (2, 2.0, None), (3, 3.0, "new")]


# ---- reshape ----


@pytest.fixture
def sales(spark):
    data = [("p", "x", 1.0), ("p", "x", 2.0), ("p", "All", 4.0), ("q", "x", None), ("All", "y", 8.0), (None, "x", 100.0)]
    return spark.createDataFrame(data, "cat string, seller string, revenue double")


def test_pivot_gaps_are_null(sales, rows):
    assert rows(reshape.pivot(sales, ["cat"], "seller", "revenue", "sum")) == [("All", None, None, 8.0), ("p", 4.0, 3.0, None), ("q", None, None, None)]


def test_margins_keep_a_real_all_key_apart(sales, rows):
    with pytest.raises(ValueError):
        reshape.pivot_margins(sales, ["cat"], "seller", "revenue", "sum")
    got = reshape.pivot_margins(sales.filter("seller <> 'All'"), ["cat"], "seller", "revenue", "sum")
    assert got.columns == ["cat", "x", "y", "All", "is_total"]
    assert rows(got) == [("All", 3.0, 8.0, 11.0, True), ("All", None, 8.0, 8.0, False), ("p", 3.0, None, 3.0, False), ("q", None, None, None, False)]


def test_mean_margins_use_raw_rows(spark, rows):
    df = spark.createDataFrame([("p", "x", 1.0), ("p", "x", 2.0), ("p", "y", 6.0)], "cat string, seller string, v double")
    assert rows(reshape.pivot_margins(df, ["cat"], "seller", "v", "mean")) == [("All", 1.5, 6.0, 3.0, True), ("p", 1.5, 6.0, 3.0, False)]


def test_max_with_mean_margins(spark, rows):
    df = spark.createDataFrame([("p", "x", 1.0), ("p", "x", 3.0), ("p", "y", 5.0), ("q", "x", 9.0)], "cat string, seller string, v double")
    assert rows(reshape.pivot_max_mean_margins(df, "cat", "seller", "v")) == [
        ("All_mean", 6.0, 5.0, 6.5, True), ("p", 3.0, 5.0, 4.0, False), ("q", 9.0, None, 9.0, False)
    ]


def test_unstack_stack_round_trip(spark, rows):
    df = spark.createDataFrame([("bar", "one", 1.0), ("bar", "two", 2.0), ("foo", "two", 3.0)], "a string, b string, c double")
    wide = reshape.unstack(df, ["a"], "b", ["c"])
    assert rows(wide) == [("bar", 1.0, 2.0), ("foo", None, 3.0)]
    back = reshape.stack(wide, ["a"], ["c_one", "c_two"], "b", "c").withColumn("b", F.replace("b", F.lit("c_"), F.lit("")))
    assert rows(back) == rows(df)


# ---- sets, projections, filters ----


def test_sets(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string")
    b = spark.createDataFrame([("y",), (None,), ("z",)], "v string")
    assert rows(sets.union_distinct(a, b)) == [("x",), ("y",), ("z",), (None,)]
    assert rows(sets.intersect(a, b)) == [("y",), (None,)]
    assert rows(sets.except_distinct(a, b)) == [("x",)]


def test_concat_rows(spark, rows):
    a, b = spark.createDataFrame([(1, "p")], "k int, s string"), spark.createDataFrame([(2,)], "k int")
    assert rows(sets.concat_rows([a, b])) == [(1, "p"), (2, None)]
    assert rows(sets.concat_rows([a, b], "inner")) == [(1,), (2,)]


def test_projections(spark):
    df = spark.createDataFrame([(1, "2")], "b int, a string")
    assert project.sort_columns_by_name(df).columns == ["a", "b"]
    assert project.rename_by_map(df, {"a": "z", "A": "q", "missing": "m"}).columns == ["b", "z"]
    assert project.add_missing_columns(df, {"a": "string", "c": "double"}).dtypes[-1] == ("c", "double")
    assert project.cast_columns(df, {"a": "int"}).first().a == 2
    assert tuple(project.apply_per_column(df, {"b": lambda c: c**2}).first()) == (1.0, "2")


def test_filters(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    yes, no = filters.split_by(df, F.col("s") == "a")
    assert rows(yes) == [(1, "a")] and rows(no) == [(2, None)]
    assert rows(filters.filter_types(df, "s", "a")) == rows(filters.filter_types(df, "s", ["a"])) == [(1, "a")]
    assert filters.exists_flag(df, F.col("s").isNull(), "y", "n", "f").first().f == "y"
    assert rows(filters.lookup(df, k=1, s="a")) == [(1, "a")]


# ---- scalar functions: values stated by the workloads ----


def test_golden_values(spark):
    checks = [
        ("1 + 2", 3), ("5 * 4", 20), ("4 % 3", 1), ("1 div 10", 0), ("CAST(1 / 10.0 AS double)", 0.1),
        ("floor(3.45)", 3), ("ceil(3.45)", 4), ("CAST(round(3.45, 1) AS double)", 3.5),
        ("7 div 2", 3), ("CAST(7.0 / 2 AS double)", 3.5), ("85000 div 7", 12142), ("85000 / 7D", 85000 / 7),
        ("((1 + 29 + 1) * 2) % 3", 2), ("upper('Toyota')", "TOYOTA"), ("lower('Toyota')", "toyota"),
        ("NULL + 5", None), ("'text' || NULL", None), ("10 * NULL", None),
        ("to_date('01.01.2019', 'dd.MM.yyyy')", datetime.date(2019, 1, 1)),
    ]
    row = spark.sql("SELECT " + ", ".join(f"{e} AS c{i}" for i, (e, _) in enumerate(checks))).first()
    assert list(row) == [v for _, v in checks]


def test_column_functions(spark):
    df = spark.createDataFrame([("grand cherokee limited", 2015, "1,234.50", "")], "name string, year int, n string, ts string")
    r = df.select(
        fn.capitalise(F.col("name")), fn.composite_code(F.col("name"), F.col("year")), fn.parse_number_grouped(F.col("n")),
        fn.month_key_text(F.col("ts")), fn.floor_div(F.col("year"), F.lit(7)), fn.miles_to_thousand_km(F.lit(1000.0)),
        *fn.split_columns(F.col("name"), " ", 4, list("abcd")), *fn.split_columns(F.col("name"), " ", 2, ["h", "t"], limit=2),
    ).first()
    assert list(r) == ["Grand cherokee limited", "ID-GRAND_CHEROKEE_LIMITED-2015", 1234.5, None, 287, 1.60934,
                       "grand", "cherokee", "limited", None, "grand", "cherokee limited"]


@pytest.mark.parametrize("text, expected", [
    ("2019-03-04 05:06:07", "2019-03-04 05:06:07"), ("03/04/2019 05:06:07 PM", "2019-03-04 17:06:07"),
    ("3/4/2019 5:06:07 AM", "2019-03-04 05:06:07"), ("12/31/2019 12:00:00 AM", "2019-12-31 00:00:00"),
    ("13/01/2019 01:00:00 AM", None), ("2019-02-30 00:00:00", None), ("n/a", None), ("", None), (None, None),
])
def test_parse_timestamp(spark, text, expected):
    value = spark.createDataFrame([(text,)], "t string").select(fn.parse_timestamp_multi(F.col("t")).cast("string")).first()[0]
    assert value == expected


# ---- user functions ----


def test_separators_are_literal_and_no_piece_is_lost(spark, rows):
    df = spark.createDataFrame([(1, "ab|cd"), (2, "a|b|c|d|e"), (3, None), (4, "")], "k int, t string")
    assert rows(apply.word_rows(df.where("k = 1"), "k", "t", "|")) == [(1, "ab"), (1, "cd")]
    wide = apply.split_expand(df, "t", "|", "p")
    assert wide.columns == ["k", "t", "p0", "p1", "p2", "p3", "p4"]
    assert rows(wide.where("k = 2"), "p0", "p4") == [("a", "e")] and rows(wide.where("k = 3"), "p0") == [(None,)]


def test_patterns_in_the_given_order(spark):
    df = spark.createDataFrame([("03/04/2024", "20240304")], "a string, b string")
    both = df.select(fn.parse_timestamp_multi(F.col("a"), ("MM/dd/yyyy", "d/M/yyyy")), fn.parse_timestamp_multi(F.col("b"), ("yyyyMMdd",)))
    assert [str(v) for v in both.first()] == ["2024-03-04 00:00:00"] * 2


def test_whole_numbers_with_a_point(spark):
    df = spark.createDataFrame([("1.0",), ("2",), ("2.5",), ("x",), ("99999999999",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.parse_integer(F.col("t"))).collect()] == [1, 2, None, None, None, None]


def test_pivot_takes_values_from_the_data(spark, rows):
    df = spark.createDataFrame([("p", "new status", 1.0), ("p", "F", 2.0)], "k string, s string, v double")
    assert reshape.pivot(df, ["k"], "s", "v", "sum").columns == ["k", "F", "new status"]
    spark.conf.set("spark.sql.pivotMaxValues", 1)
    try:
        with pytest.raises(ValueError):
            reshape.pivot(df, ["k"], "s", "v", "sum")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_separator_with_a_quote(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, s string")
    assert rows(aggregates.string_agg_ordered(df, ["k"], "s", "s", sep="'\\")) == [(1, "a'\\b")]


def test_row_and_group_functions(spark, rows):
    df = spark.createDataFrame([("s", 2.0), ("v", 3.0), ("o", 4.0), (None, 5.0)], "g string, v double")
    assert rows(apply.row_apply(df, lambda p: p.v + 1, "w", "double"), "w") == [(3.0,), (4.0,), (5.0,), (6.0,)]
    powers = {"s": lambda g: g.assign(v=g.v**2), "v": lambda g: g.assign(v=g.v**3)}
    assert rows(apply.group_apply_rowwise(df, "g", powers)) == [("o", 4.0), ("s", 4.0), ("v", 27.0), (None, 5.0)]
    total = apply.group_apply(df, ["g"], lambda g: pd.DataFrame({"n": [len(g)]}), "n long")
    assert rows(total) == [(1,)] * 4
    with pytest.raises(aggregates.GroupTooLargeError):
        apply.group_apply(df, ["g"], lambda g: g, "g string, v double", group_bound=0)


def test_nan_is_missing_in_reports(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "v double")
    r = aggregates.describe(df, ["v"]).first()
    assert (r.v_count, r.v_mean, r.v_max, r.v_p50) == (2, 2.0, 3.0, 2.0)


def test_short_prefix_is_a_top_n(spark, rows, plan_of):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert rows(ordering.slice_positions(df, ["k"], 1, 6, 2), "k", "pos") == [(1, 1), (3, 3), (5, 5)]
    assert rows(ordering.slice_positions(df, ["k"], 0, 2, -1), "k", "pos") == [(998, 1), (999, 0)]


def test_nan_keys_are_one_group(spark, rows):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1, 5.0), (nan, 2, None), (1.0, 3, None)], "k double, o int, v double")
    assert sorted((r.o, r.v) for r in ordering.ffill(df, ["o"], ["v"], keys=["k"]).collect()) == [(1, 5.0), (2, 5.0), (3, None)]
