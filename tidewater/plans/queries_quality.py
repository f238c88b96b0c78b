"""Integrity rules and the order mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import quality, sets
from tidewater.plans.mart import build_order_mart
from tidewater.plans.registry import query, rounded


@query(
    "check_unique_key",
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT 'l_orderkey,l_linenumber' AS key, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
    CAST(count_if(n > 1) AS BIGINT) AS n_duplicated, CASE WHEN count_if(n > 1) = 0 THEN 'unique' ELSE 'has duplicates' END AS verdict FROM k""",
)
def _(t):
    return quality.check_unique_key(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "check_foreign_key",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')",
)
def _(t):
    parents = t.orders.filter("o_orderstatus <> 'P'")
    return quality.check_foreign_key(t.lineitem.select("l_orderkey", "l_linenumber"), parents, "l_orderkey", "o_orderkey")


@query(
    "insert_with_fk_gate",
    """WITH b AS (SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN c_nationkey + 100
      ELSE c_nationkey END AS nationkey FROM customer)
    SELECT CASE WHEN nationkey >= 100 THEN 'rejected' ELSE 'accepted' END AS outcome, count(*) AS n_rows,
    CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM b GROUP BY 1""",
)
def _(t):
    k = F.col("c_custkey")
    nationkey = F.when(k % 20 == 0, None).when(k % 10 == 1, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    batch = t.customer.select("c_custkey", nationkey.alias("nationkey"))
    accepted, rejected = quality.insert_with_fk_gate(batch, t.nation, "nationkey", "n_nationkey")
    both = sets.union_all_tagged({"accepted": accepted, "rejected": rejected.drop("reject_reason")}, "outcome")
    return both.groupBy("outcome").agg(F.count("*").alias("n_rows"), F.sum("c_custkey").alias("key_sum"))


@query(
    "delete_restrict",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH')
    THEN 'kept' ELSE 'may go' END AS outcome FROM customer""",
)
def _(t):
    free, used = quality.delete_restrict(
        t.customer.select("c_custkey"), t.orders.filter("o_orderpriority = '2-HIGH'"), "c_custkey", "o_custkey"
    )
    return sets.union_all_tagged({"may go": free, "kept": used}, "outcome")


@query(
    "delete_cascade",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def _(t):
    deleted = t.customer.filter("c_acctbal < 0")
    return quality.delete_cascade(t.orders.select("o_orderkey", "o_custkey"), deleted, "o_custkey", "c_custkey")


@query(
    "delete_set_null",
    """SELECT o_orderkey, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN o_custkey END AS o_custkey
    FROM orders""",
)
def _(t):
    deleted = t.customer.filter("c_acctbal < 0")
    return quality.delete_set_null(t.orders.select("o_orderkey", "o_custkey"), deleted, "o_custkey", "c_custkey")


@query(
    "update_key",
    """SELECT 'nation' AS side, n_name AS label, n_nationkey + CASE WHEN n_regionkey = 2 THEN 1000 ELSE 0 END AS nationkey FROM nation
    UNION ALL SELECT 'customer', c_name, c_nationkey + CASE WHEN n_regionkey = 2 THEN 1000 ELSE 0 END
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t):
    changes = t.nation.filter("n_regionkey = 2").select(
        F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 1000).alias("new_key")
    )
    parent, child = quality.update_key(t.nation, t.customer, changes, "n_nationkey", "c_nationkey", "cascade")
    return sets.union_all_tagged(
        {
            "nation": parent.select(F.col("n_name").alias("label"), F.col("n_nationkey").alias("nationkey")),
            "customer": child.select(F.col("c_name").alias("label"), F.col("c_nationkey").alias("nationkey")),
        },
        "side",
    )


@query(
    "check_not_null",
    """SELECT 'status' AS column_name, count(*) - count(nullif(o_orderstatus, 'P')) AS n_missing FROM orders
    UNION ALL SELECT 'price', count(*) - count(CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END) FROM orders""",
)
def _(t):
    rows = t.orders.select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"),
    )
    return quality.check_not_null(rows, ["status", "price"])


@query(
    "check_predicate",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN year(o_orderdate) <= 1996 THEN 'recent' END,
      CASE WHEN o_totalprice >= 100000 THEN 'cheap' END) AS violations
    FROM orders WHERE year(o_orderdate) <= 1996 OR o_totalprice >= 100000""",
)
def _(t):
    rules = {"recent": F.year("o_orderdate") > 1996, "cheap": F.col("o_totalprice") < 100000}
    return quality.check_predicates(t.orders, rules).select("o_orderkey", "violations")


@query(
    "check_type",
    "SELECT l_orderkey, l_linenumber, 'n/a' AS price FROM lineitem WHERE l_linenumber = 4",
)
def _(t):
    price = F.when(F.col("l_linenumber") == 4, "n/a").when(F.col("l_linenumber") != 6, F.col("l_extendedprice").cast("string"))
    return quality.check_type(t.lineitem.select("l_orderkey", "l_linenumber", price.alias("price")), "price", "double")


@query(
    "build_mart",
    """SELECT r_name, order_year, c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue FROM
    (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY 1, 2, 3""",
)
def _(t):
    mart = build_order_mart(t.orders, t.customer, t.nation, t.region, t.scratch("order-mart"))
    return mart.groupBy("r_name", "order_year", "c_mktsegment").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )


@query(
    "apply_defaults",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'N') AS status,
    coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END, 0) AS price, 'web' AS channel FROM orders""",
)
def _(t):
    batch = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"),
    )
    return quality.apply_defaults(batch, {"status": "N", "price": 0.0, "channel": "web"})


@query(
    "surrogate_key",
    """SELECT s_name, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS c_custkey FROM supplier""",
)
def _(t):
    return quality.surrogate_key(t.supplier.select("s_name"), ["s_name"], "c_custkey", existing=t.customer)


@query(
    "normalise_split",
    """SELECT c_custkey, c_mktsegment, length(c_mktsegment) AS segment_length FROM customer""",
)
def _(t):
    """Split into customers and segments, then joined again: the rows are those of the wide table."""
    wide = t.customer.select("c_custkey", "c_mktsegment", F.length("c_mktsegment").cast("long").alias("segment_length"))
    fact, dimension = quality.normalise_split(wide, ["c_mktsegment"], ["segment_length"])
    return fact.join(dimension, "c_mktsegment").select("c_custkey", "c_mktsegment", "segment_length")
