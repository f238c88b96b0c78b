"""Projections, filters, joins, set operations, grouped aggregates and windows over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.columns import all_of, any_of
from tidewater.operators import aggregates, filters, joins, ordering, project, sets
from tidewater.plans.mart import orders_with_places
from tidewater.plans.registry import query, rounded

# ---- projection ----


@query("project_columns", "SELECT c_name, c_acctbal FROM customer")
def _(t):
    return t.customer.select("c_name", "c_acctbal")


@query(
    "project_star_join",
    "SELECT c.*, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
)
def _(t):
    c, n = t.customer.alias("c"), t.nation.alias("n")
    return c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey")).select("c.*", "n.n_name")


@query(
    "project_alias",
    "SELECT c.c_name AS customer_name, n.n_name AS nation_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
)
def _(t):
    c, n = t.customer.alias("c"), t.nation.alias("n")
    return c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey")).select(
        F.col("c.c_name").alias("customer_name"), F.col("n.n_name").alias("nation_name")
    )


@query("project_literals", "SELECT p_name, 2024 AS current_year, 'part' AS kind FROM part")
def _(t):
    return t.part.select("p_name", F.lit(2024).alias("current_year"), F.lit("part").alias("kind"))


@query(
    "cast_columns",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
    CAST(floor(o_totalprice) AS BIGINT) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""",
)
def _(t):
    whole = t.orders.withColumn("o_totalprice", F.floor("o_totalprice"))
    return project.cast_columns(
        whole, {"o_orderkey": "int", "o_custkey": "string", "o_totalprice": "bigint", "o_orderdate": "date"}
    )


@query("sort_columns_by_name", "SELECT o_totalprice, o_orderstatus, o_orderpriority, o_orderkey, o_orderdate, o_custkey FROM orders")
def _(t):
    return project.sort_columns_by_name(t.orders, descending=True)


@query(
    "axis0_column_function",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size - 1 AS p_size, round(p_retailprice * p_retailprice, 3) AS p_retailprice FROM part",
)
def _(t):
    changed = project.apply_per_column(t.part, {"p_retailprice": lambda c: c * c, "p_size": lambda c: c - 1})
    return rounded(changed, 3)


# ---- filters ----


@query("filter_compare", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 50000 AND o_orderstatus <> 'P'")
def _(t):
    return t.orders.filter((F.col("o_totalprice") < 50000) & (F.col("o_orderstatus") != "P")).select("o_orderkey", "o_totalprice")


@query(
    "filter_between_and",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000 AND o_orderstatus = 'O'",
)
def _(t):
    return t.orders.filter(
        all_of([F.col("o_totalprice").between(100000, 200000), F.col("o_orderstatus") == "O"])
    ).select("o_orderkey", "o_totalprice")


@query("filter_or", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 OR o_orderpriority = '1-URGENT'")
def _(t):
    return t.orders.filter(any_of([F.col("o_totalprice") > 400000, F.col("o_orderpriority") == "1-URGENT"])).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "filter_not",
    "SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'O' AND o_totalprice < 300000) AND o_custkey > 10 OR o_custkey = 3",
)
def _(t):
    cheap_open = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 300000)
    return t.orders.filter((~cheap_open & (F.col("o_custkey") > 10)) | (F.col("o_custkey") == 3)).select("o_orderkey")


@query("filter_isin", "SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 7, 49) AND p_type NOT IN ('ECONOMY', 'SMALL')")
def _(t):
    return t.part.filter(F.col("p_size").isin(1, 7, 49) & ~F.col("p_type").isin("ECONOMY", "SMALL")).select("p_partkey", "p_size")


NULL_STATUS_SQL = "(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)"


def orders_null_status(t):
    return t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))


@query("filter_is_null", f"SELECT o_orderkey FROM {NULL_STATUS_SQL} WHERE status IS NULL")
def _(t):
    return orders_null_status(t).filter(F.col("status").isNull()).select("o_orderkey")


@query("filter_is_not_null", f"SELECT o_orderkey, status FROM {NULL_STATUS_SQL} WHERE status IS NOT NULL")
def _(t):
    return orders_null_status(t).filter(F.col("status").isNotNull())


@query("filter_equals_null", f"SELECT count(*) AS n FROM {NULL_STATUS_SQL} WHERE status = NULL")
def _(t):
    return orders_null_status(t).filter(F.col("status") == F.lit(None)).agg(F.count("*").alias("n"))


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%o%'")
def _(t):
    return t.part.filter(F.col("p_name").like("%o%")).select("p_partkey", "p_name")


@query("filter_boolean_mask", "SELECT * FROM part WHERE p_size > 20 AND p_retailprice < 1000 OR p_brand = 'Brand#4'")
def _(t):
    mask = ((F.col("p_size") > 20) & (F.col("p_retailprice") < 1000)) | (F.col("p_brand") == "Brand#4")
    return t.part.filter(mask)


@query("filter_not_in_subquery", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(t):
    return joins.not_in(
        t.customer.select("c_custkey", "c_name"), t.orders.filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey"
    )


@query(
    "filter_not_in_with_null",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT nullif(o_custkey, 11) FROM orders)",
)
def _(t):
    listed = t.orders.select(F.nullif("o_custkey", F.lit(11)).alias("k"))
    return joins.not_in(t.customer.select("c_custkey"), listed, "c_custkey", "k")


@query(
    "exists_flag",
    """SELECT CASE WHEN EXISTS (SELECT 1 FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region))
    THEN 'broken' ELSE 'intact' END AS integrity""",
)
def _(t):
    orphans = joins.anti(t.nation, t.region, "n_regionkey", "r_regionkey")
    return filters.exists_flag(orphans, F.lit(True), "broken", "intact", "integrity")


@query(
    "project_boolean_columns",
    "SELECT p_partkey, p_size > 25 AS is_large, p_brand = 'Brand#4' AS is_brand4, p_type <> 'SMALL' AS not_small FROM part",
)
def _(t):
    return t.part.select(
        "p_partkey",
        (F.col("p_size") > 25).alias("is_large"),
        (F.col("p_brand") == "Brand#4").alias("is_brand4"),
        (F.col("p_type") != "SMALL").alias("not_small"),
    )


@query(
    "case_simple_and_searched",
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'eco' WHEN 'SMALL' THEN 'sml' ELSE 'other' END AS type_code,
    CASE WHEN p_size > 40 THEN 'big' WHEN p_size > 10 THEN 'medium' ELSE 'little' END AS size_class FROM part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.when(F.col("p_type") == "ECONOMY", "eco").when(F.col("p_type") == "SMALL", "sml").otherwise("other").alias("type_code"),
        F.when(F.col("p_size") > 40, "big").when(F.col("p_size") > 10, "medium").otherwise("little").alias("size_class"),
    )


@query("filter_date_extract", "SELECT o_orderkey FROM orders WHERE extract(year FROM CAST(o_orderdate AS DATE)) = 1997")
def _(t):
    return t.orders.filter(F.expr("extract(year FROM CAST(o_orderdate AS DATE)) = 1997")).select("o_orderkey")


@query("filter_lookup_key", "SELECT * FROM orders WHERE o_orderkey = 5")
def _(t):
    return filters.lookup(t.orders, o_orderkey=5)


@query(
    "filter_lookup_multi_key",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber = 3",
)
def _(t):
    return filters.lookup(t.lineitem, l_returnflag="A", l_linestatus="F", l_linenumber=3).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


# ---- joins ----


@query("join_inner", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    return joins.join_on_names(t.customer, t.nation, "c_nationkey", "n_nationkey").select("c_custkey", "c_name", "n_name")


def _orders_by_customer(t):
    return t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")


def _customers(t):
    return t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")


@query(
    "join_left",
    """SELECT c_custkey AS custkey, c_name, o_orderkey, o_totalprice FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey""",
)
def _(t):
    open_orders = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    return joins.skew_join(_customers(t), open_orders, ["custkey"], "left")


@query(
    "join_right",
    """SELECT c_custkey AS custkey, o_orderkey, o_totalprice, c_name FROM orders
    RIGHT JOIN customer ON c_custkey = o_custkey""",
)
def _(t):
    return joins.skew_join(_orders_by_customer(t), _customers(t), ["custkey"], "right")


@query(
    "join_full_outer",
    """WITH s AS (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1),
    c AS (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1)
    SELECT nationkey, n_suppliers, n_customers FROM s FULL JOIN c USING (nationkey)""",
)
def _(t):
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("n_suppliers"))
    c = t.customer.filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("n_customers"))
    return s.join(c, "nationkey", "full")


@query(
    "join_star_four",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    return orders_with_places(t.orders, t.customer, t.nation, t.region).select("o_orderkey", "c_name", "n_name", "r_name")


@query("join_cross", "SELECT r_name, n_name FROM region, nation")
def _(t):
    return joins.cartesian(t.region.select("r_name"), t.nation.select("n_name"))


@query("join_different_key_names", "SELECT l_orderkey, l_linenumber, l_partkey, p_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def _(t):
    return joins.join_on_names(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey"
    )


@query(
    "join_same_key_suffixes",
    """SELECT a.n_nationkey AS key, upper(a.n_name) AS name_x, a.n_regionkey AS grp_x, b.n_name AS name_y, b.n_regionkey + 1 AS grp_y
    FROM nation a JOIN nation b ON a.n_nationkey = b.n_nationkey""",
)
def _(t):
    left = t.nation.select(F.col("n_nationkey").alias("key"), F.upper("n_name").alias("name"), F.col("n_regionkey").alias("grp"))
    right = t.nation.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 1).alias("grp"))
    return joins.join_suffixed(left, right, ["key"])


@query(
    "join_on_index",
    "SELECT o_custkey AS label, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def _(t):
    left = t.orders.select(F.col("o_custkey").alias("label"), "o_orderkey")
    return joins.join_suffixed(left, t.customer.select(F.col("c_custkey").alias("label"), "c_name"), ["label"])


@query(
    "join_validated",
    "SELECT n_regionkey AS regionkey, n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def _(t):
    left = t.nation.select(F.col("n_regionkey").alias("regionkey"), "n_nationkey", "n_name")
    right = t.region.select(F.col("r_regionkey").alias("regionkey"), "r_name")
    return joins.join_validated(left, right, ["regionkey"], "m:1")


SIDE_SQL = """SELECT a.c_custkey, a.c_name AS c_name_x, a.c_acctbal AS c_acctbal_x, b.c_name AS c_name_y, b.c_acctbal AS c_acctbal_y
    FROM customer a {how} JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) b ON a.c_custkey = b.c_custkey"""


def _side_by_side(t, how):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return joins.concat_columns(rows, rows.filter("c_acctbal > 5000"), "c_custkey", how)


@query("concat_columns_outer", SIDE_SQL.format(how="LEFT"))
def _(t):
    return _side_by_side(t, "full")


@query("concat_columns_inner", SIDE_SQL.format(how="INNER"))
def _(t):
    return _side_by_side(t, "inner")


@query(
    "align_add",
    """WITH s AS (SELECT s_nationkey AS nationkey, sum(s_acctbal) AS v FROM supplier GROUP BY 1),
    c AS (SELECT c_nationkey AS nationkey, sum(c_acctbal) AS v FROM customer WHERE c_nationkey <> 4 GROUP BY 1)
    SELECT nationkey, round(s.v + c.v, 2) AS balance FROM s FULL JOIN c USING (nationkey)""",
)
def _(t):
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.sum("s_acctbal").alias("balance"))
    c = t.customer.filter("c_nationkey <> 4").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.sum("c_acctbal").alias("balance"))
    return rounded(joins.align_add(s, c, "nationkey", "balance"), 2)


@query("scalar_subquery", "SELECT p_partkey, p_retailprice, round((SELECT avg(p_retailprice) FROM part), 4) AS avg_price FROM part")
def _(t):
    return rounded(
        joins.with_scalar(t.part.select("p_partkey", "p_retailprice"), t.part, F.avg("p_retailprice"), "avg_price"), 4, "avg_price"
    )


@query(
    "semi_anti",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    THEN 'with' ELSE 'without' END AS side FROM customer""",
)
def _(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    c = t.customer.select("c_custkey")
    with_orders, without = joins.semi_and_anti(c, urgent, "c_custkey", "o_custkey")
    return sets.union_all_tagged({"with": with_orders, "without": without}, "side")


# ---- set operations ----

BRANDS = "SELECT p_brand FROM part WHERE {cond}"


def _brands(t, condition):
    return t.part.filter(condition).select("p_brand")


@query("union_distinct", BRANDS.format(cond="p_size > 48") + " UNION " + BRANDS.format(cond="p_retailprice < 905"))
def _(t):
    return sets.union_distinct(_brands(t, "p_size > 48"), _brands(t, "p_retailprice < 905"))


@query("intersect", BRANDS.format(cond="p_size > 45") + " INTERSECT " + BRANDS.format(cond="p_retailprice < 910"))
def _(t):
    return sets.intersect(_brands(t, "p_size > 45"), _brands(t, "p_retailprice < 910"))


@query("except", BRANDS.format(cond="p_size > 10") + " EXCEPT " + BRANDS.format(cond="p_retailprice < 903"))
def _(t):
    return sets.except_distinct(_brands(t, "p_size > 10"), _brands(t, "p_retailprice < 903"))


@query(
    "union_all_tagged",
    """SELECT c_name AS name, c_nationkey AS nationkey, 'customer' AS role FROM customer
    UNION ALL SELECT s_name, s_nationkey, 'supplier' FROM supplier""",
)
def _(t):
    return sets.union_all_tagged(
        {
            "customer": t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey")),
            "supplier": t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")),
        },
        "role",
    )


@query(
    "concat_rows_outer",
    """SELECT p_partkey, p_name, p_size FROM part UNION ALL SELECT p_partkey, p_name, NULL FROM part""",
)
def _(t):
    return sets.concat_rows([t.part.select("p_partkey", "p_name", "p_size"), t.part.select("p_partkey", "p_name")])


@query("concat_rows_inner", "SELECT p_partkey, p_name FROM part UNION ALL SELECT p_partkey, p_name FROM part")
def _(t):
    return sets.concat_rows([t.part.select("p_partkey", "p_name", "p_size"), t.part.select("p_partkey", "p_name")], "inner")


# ---- aggregates ----


@query("count_distinct", "SELECT count(DISTINCT o_custkey) AS n_customers, count(*) AS n_orders, count(DISTINCT o_custkey) = count(*) AS is_unique FROM orders")
def _(t):
    return t.orders.agg(F.countDistinct("o_custkey").alias("n_customers"), F.count("*").alias("n_orders")).withColumn(
        "is_unique", F.col("n_customers") == F.col("n_orders")
    )


@query("group_avg", "SELECT p_brand, round(avg(p_retailprice), 4) AS avg_price FROM part GROUP BY p_brand")
def _(t):
    return rounded(t.part.groupBy("p_brand").agg(F.avg("p_retailprice").alias("avg_price")), 4)


@query("expr_over_aggregate", "SELECT p_brand, count(*) AS n_parts, count(*) * 1000 AS bonus FROM part GROUP BY p_brand")
def _(t):
    return t.part.groupBy("p_brand").agg(F.count("*").alias("n_parts"), (F.count("*") * 1000).alias("bonus"))


@query("string_agg_ordered", "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY n_regionkey")
def _(t):
    return aggregates.string_agg_ordered(t.nation, ["n_regionkey"], "n_name", "n_name", name="nations")


# ---- order and windows ----


@query("sort_multi", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordering.sort_rows(rows, F.col("o_orderpriority").asc_nulls_first(), F.col("o_totalprice").desc_nulls_last())


@query("sort_by_label", "SELECT * FROM customer ORDER BY c_custkey DESC")
def _(t):
    return ordering.sort_rows(t.customer, F.col("c_custkey").desc())


@query("limit_ordered", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("row_number_label", "SELECT 'row ' || row_number() OVER (ORDER BY c_custkey) AS row_label, c_custkey, c_name FROM customer")
def _(t):
    return ordering.row_labels(t.customer.select("c_custkey", "c_name"), ["c_custkey"]).select("row_label", "c_custkey", "c_name")
