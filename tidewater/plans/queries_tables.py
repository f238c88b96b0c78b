"""Table analytics: statistics, missing values, positions, ranks and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import aggregates, missing, ordering, reshape
from tidewater.plans.registry import query, rounded

# ---- holes: orders with missing prices and statuses ----

HOLES_SQL = """WITH holes AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice, o_custkey FROM orders)
"""


def orders_with_holes(t):
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        "o_custkey",
    )


@query(
    "null_counts",
    HOLES_SQL
    + """SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(o_orderstatus) AS o_orderstatus,
    count(*) - count(o_totalprice) AS o_totalprice, count(*) - count(o_custkey) AS o_custkey,
    4 * count(*) - count(o_orderkey) - count(o_orderstatus) - count(o_totalprice) - count(o_custkey) AS total_nulls FROM holes""",
)
def _(t):
    return missing.null_counts(orders_with_holes(t))


@query(
    "null_mask",
    HOLES_SQL + "SELECT o_orderkey IS NULL AS o_orderkey, o_orderstatus IS NULL AS o_orderstatus, o_totalprice IS NULL AS o_totalprice, o_custkey IS NULL AS o_custkey FROM holes",
)
def _(t):
    return missing.null_mask(orders_with_holes(t))


@query("drop_rows_with_null", HOLES_SQL + "SELECT * FROM holes WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL")
def _(t):
    return missing.drop_rows_with_null(orders_with_holes(t))


@query("drop_columns_with_null", HOLES_SQL + "SELECT o_orderkey, o_custkey FROM holes")
def _(t):
    return missing.drop_columns_with_null(orders_with_holes(t))


@query("fill_scalar", HOLES_SQL + "SELECT o_orderkey, o_orderstatus, coalesce(o_totalprice, 0) AS o_totalprice, o_custkey FROM holes")
def _(t):
    return missing.fill_scalar(orders_with_holes(t), 0)


@query(
    "fill_by_column",
    HOLES_SQL + "SELECT o_orderkey, coalesce(o_orderstatus, 'none') AS o_orderstatus, coalesce(o_totalprice, 1) AS o_totalprice, o_custkey FROM holes",
)
def _(t):
    return missing.fill_by_column(orders_with_holes(t), {"o_orderstatus": "none", "o_totalprice": 1.0})


@query(
    "update_cells",
    """SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN 10 AND 20 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey BETWEEN 10 AND 20 THEN 1.5 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return missing.update_cells(rows, F.col("o_orderkey").between(10, 20), {"o_orderstatus": "X", "o_totalprice": 1.5})


# ---- statistics ----


@query(
    "profile_relation",
    HOLES_SQL
    + """SELECT 'orders' AS relation, 4 AS degree, count(*) AS cardinality,
    'orders(o_orderkey, o_orderstatus, o_totalprice, o_custkey)' AS notation, count(o_orderkey) AS o_orderkey_non_null,
    count(o_orderstatus) AS o_orderstatus_non_null, count(o_totalprice) AS o_totalprice_non_null,
    count(o_custkey) AS o_custkey_non_null FROM holes""",
)
def _(t):
    return aggregates.profile_relation(orders_with_holes(t), "orders")


@query(
    "column_stats",
    "SELECT "
    + ", ".join(
        f"round(avg({c}), 4) AS {c}_mean, round(stddev_samp({c}), 4) AS {c}_std, round(var_samp({c}), 4) AS {c}_var"
        for c in ("p_size", "p_retailprice")
    )
    + " FROM part",
)
def _(t):
    return rounded(aggregates.column_stats(t.part, ["p_size", "p_retailprice"]), 4)


@query("value_counts", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def _(t):
    return aggregates.value_counts(t.part, "p_type")


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def _(t):
    return t.orders.select("o_orderpriority").distinct()


def describe_sql(columns: tuple[str, ...]) -> str:
    return ", ".join(
        f"""count({c}) AS {c}_count, round(avg({c}), 4) AS {c}_mean, round(stddev_samp({c}), 4) AS {c}_std, min({c}) AS {c}_min,
        max({c}) AS {c}_max, round(quantile_cont({c}, 0.25), 4) AS {c}_p25, round(quantile_cont({c}, 0.5), 4) AS {c}_p50,
        round(quantile_cont({c}, 0.75), 4) AS {c}_p75"""
        for c in columns
    )


DERIVED = [f"{c}_{s}" for c in ("l_quantity", "l_extendedprice") for s in ("mean", "std", "p25", "p50", "p75")]


@query("describe", f"SELECT {describe_sql(('l_quantity', 'l_extendedprice'))} FROM lineitem")
def _(t):
    return rounded(aggregates.describe(t.lineitem, ["l_quantity", "l_extendedprice"]), 4, *DERIVED)


@query("group_describe", f"SELECT l_returnflag, {describe_sql(('l_quantity', 'l_extendedprice'))} FROM lineitem GROUP BY l_returnflag")
def _(t):
    return rounded(aggregates.describe(t.lineitem, ["l_quantity", "l_extendedprice"], ["l_returnflag"]), 4, *DERIVED)


@query("quantiles_split_groups", f"SELECT l_returnflag, {describe_sql(('l_quantity', 'l_extendedprice'))} FROM lineitem GROUP BY l_returnflag")
def _(t):
    """The same report by the way taken when a group exceeds one task."""
    report = aggregates.describe(t.lineitem, ["l_quantity", "l_extendedprice"], ["l_returnflag"], group_bound=0)
    return rounded(report, 4, *DERIVED)


@query(
    "group_min_max",
    "SELECT p_type, min(p_retailprice) AS p_retailprice_min, max(p_retailprice) AS p_retailprice_max, min(p_size) AS p_size_min, max(p_size) AS p_size_max FROM part GROUP BY p_type",
)
def _(t):
    return aggregates.group_agg(t.part, ["p_type"], {"p_retailprice": ["min", "max"], "p_size": ["min", "max"]})


@query(
    "group_multi_agg",
    """SELECT o_orderpriority, max(o_totalprice) AS o_totalprice_max, min(o_totalprice) AS o_totalprice_min,
    round(avg(o_totalprice), 4) AS o_totalprice_mean, round(median(o_totalprice), 4) AS o_totalprice_median,
    max(o_custkey) AS o_custkey_max FROM orders GROUP BY o_orderpriority""",
)
def _(t):
    result = aggregates.group_agg(
        t.orders, ["o_orderpriority"], {"o_totalprice": ["max", "min", "mean", "median"], "o_custkey": ["max"]}
    )
    return rounded(result, 4, "o_totalprice_mean", "o_totalprice_median")


@query(
    "group_avg_multi_key",
    "SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 4) AS o_totalprice_mean FROM orders GROUP BY 1, 2",
)
def _(t):
    return rounded(aggregates.group_means(t.orders, ["o_orderstatus", "o_orderpriority"], ["o_totalprice"]), 4)


@query(
    "group_argless_stats",
    """SELECT p_type, round(avg(p_partkey), 4) AS p_partkey_mean, round(avg(p_size), 4) AS p_size_mean,
    round(avg(p_retailprice), 4) AS p_retailprice_mean FROM part GROUP BY p_type""",
)
def _(t):
    return rounded(aggregates.group_means(t.part, ["p_type"]), 4)


# ---- positions, fills, ranks ----


@query(
    "dense_rank_in_group",
    """SELECT p_partkey, p_type, size, CASE WHEN size IS NOT NULL THEN
    CAST(dense_rank() OVER (PARTITION BY p_type ORDER BY size NULLS LAST) AS INTEGER) END AS size_rank
    FROM (SELECT p_partkey, p_type, nullif(p_size, 7) AS size FROM part)""",
)
def _(t):
    rows = t.part.select("p_partkey", "p_type", F.nullif("p_size", F.lit(7)).alias("size"))
    return ordering.dense_rank_in_group(rows, ["p_type"], "size", "size_rank")


@query(
    "dense_rank_split_groups",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
    CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS INTEGER) AS qty_rank FROM lineitem""",
)
def _(t):
    """The way taken when a group exceeds one task."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return ordering.dense_rank_in_group(rows, ["l_returnflag"], "l_quantity", "qty_rank", group_bound=0)


def fill_sql(direction: str, key: str = "") -> str:
    frame = {
        "ffill": "last_value(v IGNORE NULLS) OVER ({p} ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "bfill": "first_value(v IGNORE NULLS) OVER ({p} ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
    }[direction].format(p=f"PARTITION BY {key}" if key else "")
    return f"""WITH e AS (SELECT event_id, ts, event_type, CASE WHEN event_id % 4 = 1 THEN value END AS v FROM events)
    SELECT event_id, ts, event_type, {frame} AS v FROM e"""


def events_with_holes(t):
    return t.events.select("event_id", "ts", "event_type", F.when(F.col("event_id") % 4 == 1, F.col("value")).alias("v"))


@query("ffill", fill_sql("ffill"))
def _(t):
    return ordering.ffill(events_with_holes(t), ["ts", "event_id"], ["v"])


@query("bfill", fill_sql("bfill"))
def _(t):
    return ordering.bfill(events_with_holes(t), ["ts", "event_id"], ["v"])


@query("ffill_by_key", fill_sql("ffill", "event_type"))
def _(t):
    return ordering.ffill(events_with_holes(t), ["ts", "event_id"], ["v"], ["event_type"])


@query(
    "reset_index",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY f, o_orderkey) - 1 AS index FROM
    (SELECT 0 AS f, o_orderkey, o_totalprice FROM orders UNION ALL SELECT 1, o_orderkey, o_totalprice FROM orders)""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return ordering.concat_reset_index([rows, rows], ["o_orderkey"])


@query(
    "head_tail",
    """(SELECT o_orderkey, 'head' AS side FROM orders ORDER BY o_orderkey LIMIT 5)
    UNION ALL (SELECT o_orderkey, 'tail' FROM orders ORDER BY o_orderkey DESC LIMIT 3)""",
)
def _(t):
    keys = t.orders.select("o_orderkey")
    first = ordering.head(keys, ["o_orderkey"], 5).withColumn("side", F.lit("head"))
    return first.unionByName(ordering.tail(keys, ["o_orderkey"], 3).withColumn("side", F.lit("tail")))


@query("sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || '-11'), o_orderkey LIMIT 100")
def _(t):
    return ordering.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 100, seed=11)


@query(
    "slice_positions",
    """SELECT * FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders)
    WHERE pos >= 5 AND (pos - 5) % 3 = 0""",
)
def _(t):
    return ordering.slice_positions(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], start=5, step=3)


@query(
    "slice_reversed",
    """SELECT * FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS pos FROM customer) WHERE pos % 2 = 0""",
)
def _(t):
    return ordering.slice_positions(t.customer.select("c_custkey"), ["c_custkey"], step=-2)


@query("slice_labels", "SELECT c_custkey, c_name FROM customer WHERE c_name BETWEEN 'Customer#000000010' AND 'Customer#000000020'")
def _(t):
    return ordering.slice_labels(t.customer, "c_name", "Customer#000000010", "Customer#000000020", ["c_custkey", "c_name"])


# ---- reshape ----

# for the SQL side, which must name its columns; the queries take the values from the data
STATUSES = ["F", "O", "P"]
CELLS = "{f}(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END)"


def pivot_sql(function: str, digits: int | None = 2) -> str:
    cells = []
    for s in STATUSES:
        cell = CELLS.format(f=function, s=s)
        cells.append((f"round({cell}, {digits})" if digits is not None else cell) + f' AS "{s}"')
    return f"SELECT o_orderpriority, {', '.join(cells)} FROM orders GROUP BY o_orderpriority"


@query("pivot_sum", pivot_sql("sum"))
def _(t):
    return rounded(reshape.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", "o_totalprice", "sum"), 2)


@query("pivot_count", pivot_sql("count", None))
def _(t):
    return reshape.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", "o_totalprice", "count")


@query("crosstab_agg", pivot_sql("max"))
def _(t):
    return rounded(reshape.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", "o_totalprice", "max"), 2)


MARGIN_CELLS = ", ".join(f"round({CELLS.format(f='sum', s=s)}, 2) AS \"{s}\"" for s in STATUSES) + ', round(sum(o_totalprice), 2) AS "All"'


@query(
    "pivot_margins",
    f"""SELECT o_orderpriority, {MARGIN_CELLS}, false AS is_total FROM orders GROUP BY o_orderpriority
    UNION ALL SELECT 'All', {MARGIN_CELLS}, true FROM orders""",
)
def _(t):
    return rounded(
        reshape.pivot_margins(t.orders, ["o_orderpriority"], "o_orderstatus", "o_totalprice", "sum"), 2
    )


@query(
    "pivot_max_mean_margins",
    f"""WITH cells AS ({pivot_sql("max", None)}),
    body AS (SELECT *, ("F" + "O" + "P") / 3 AS "All_mean" FROM cells),
    all_rows AS (SELECT *, false AS is_total FROM body
      UNION ALL SELECT 'All_mean', avg("F"), avg("O"), avg("P"), avg("All_mean"), true FROM body)
    SELECT o_orderpriority, round("F", 3) AS "F", round("O", 3) AS "O", round("P", 3) AS "P", round("All_mean", 3) AS "All_mean",
    is_total FROM all_rows""",
)
def _(t):
    return rounded(reshape.pivot_max_mean_margins(t.orders, "o_orderpriority", "o_orderstatus", "o_totalprice"), 3)


@query(
    "pivot_multi_index",
    f"""SELECT o_orderpriority, CAST(year(o_orderdate) AS VARCHAR) AS order_year, {MARGIN_CELLS}, false AS is_total
    FROM orders GROUP BY 1, 2 UNION ALL SELECT 'All', '', {MARGIN_CELLS}, true FROM orders""",
)
def _(t):
    rows = t.orders.withColumn("order_year", F.year("o_orderdate"))
    return rounded(
        reshape.pivot_margins(rows, ["o_orderpriority", "order_year"], "o_orderstatus", "o_totalprice", "sum"), 2
    )


def _status_means(t):
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.round(F.avg("o_totalprice"), 4).alias("price"), F.count("*").cast("double").alias("n")
    )


@query(
    "unstack",
    "SELECT o_orderpriority, "
    + ", ".join(
        f"round({CELLS.format(f='avg', s=s)}, 4) AS price_{s}, CAST(count(CASE WHEN o_orderstatus = '{s}' THEN 1 END) AS DOUBLE) AS n_{s}"
        for s in STATUSES
    )
    + " FROM orders GROUP BY o_orderpriority",
)
def _(t):
    return reshape.unstack(_status_means(t), ["o_orderpriority"], "o_orderstatus", ["price", "n"])


@query(
    "stack",
    " UNION ALL ".join(
        f"SELECT o_orderpriority, 'price_{s}' AS cell, round(avg(o_totalprice), 4) AS v FROM orders WHERE o_orderstatus = '{s}' GROUP BY 1"
        for s in STATUSES
    ),
)
def _(t):
    wide = reshape.unstack(_status_means(t), ["o_orderpriority"], "o_orderstatus", ["price"])
    return reshape.stack(wide, ["o_orderpriority"], [c for c in wide.columns if c.startswith("price_")], "cell", "v")


@query(
    "transpose_small",
    """WITH m AS (SELECT r_name, CAST(count(*) AS DOUBLE) AS n_customers, round(avg(c_acctbal), 4) AS avg_balance
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name),
    long AS (SELECT 'n_customers' AS key, r_name, n_customers AS v FROM m UNION ALL SELECT 'avg_balance', r_name, avg_balance FROM m)
    SELECT key, """
    + ", ".join(f"max(CASE WHEN r_name = '{r}' THEN v END) AS \"{r}\"" for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
    + " FROM long GROUP BY key",
)
def _(t):
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    report = (
        t.customer.join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name")
        .agg(F.count("*").cast("double").alias("n_customers"), F.round(F.avg("c_acctbal"), 4).alias("avg_balance"))
    )
    return reshape.transpose_report(report, "r_name")
