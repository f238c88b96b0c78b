"""Scalar functions over the star schema."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidewater.functions import columns as fn
from tidewater.operators.apply import group_apply, group_apply_rowwise, row_apply, split_expand, word_rows
from tidewater.plans.registry import query, rounded


@query(
    "arith_int_float",
    """SELECT p_partkey, p_size + 5 AS plus5, p_size - 3 AS minus3, p_size * 4 AS times4, p_size % 3 AS mod3,
    CAST(p_size // 7 AS BIGINT) AS div7, round(p_size / 7.0, 6) AS over7 FROM part""",
)
def _(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        (size + 5).alias("plus5"),
        (size - 3).alias("minus3"),
        (size * 4).alias("times4"),
        (size % 3).alias("mod3"),
        fn.floor_div(size, F.lit(7)).alias("div7"),
        F.round(size / F.lit(7.0), 6).alias("over7"),
    )


@query(
    "round_floor_ceil",
    """SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS fl, CAST(ceil(p_retailprice) AS BIGINT) AS ce,
    round(p_retailprice / 7.0, 1) AS r1, (round(p_retailprice / 7.0, 1) + 5) * 10 AS score FROM part""",
)
def _(t):
    price = F.col("p_retailprice")
    tenth = F.round(price / 7.0, 1)
    return t.part.select(
        "p_partkey", F.floor(price).alias("fl"), F.ceil(price).alias("ce"), tenth.alias("r1"), ((tenth + 5) * 10).alias("score")
    )


@query("unit_convert", "SELECT p_partkey, round(p_size * 1.60934::DOUBLE / 1000, 8) AS thousand_km FROM part")
def _(t):
    return rounded(t.part.select("p_partkey", fn.miles_to_thousand_km(F.col("p_size")).alias("thousand_km")), 8)


@query("case_change", "SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low FROM part")
def _(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"))


@query("concat_text", "SELECT p_partkey, p_name || ' part' AS description, 'Name: ' || p_name || ', size: ' || p_size AS info FROM part")
def _(t):
    return t.part.select(
        "p_partkey",
        F.concat("p_name", F.lit(" part")).alias("description"),
        F.concat(F.lit("Name: "), "p_name", F.lit(", size: "), F.col("p_size").cast("string")).alias("info"),
    )


@query("substr_left_right", "SELECT p_partkey, substring(p_name, 1, 3) AS first3, left(p_name, 2) AS left2, right(p_name, 2) AS right2 FROM part")
def _(t):
    return t.part.select(
        "p_partkey",
        F.substring("p_name", 1, 3).alias("first3"),
        F.left("p_name", F.lit(2)).alias("left2"),
        F.right("p_name", F.lit(2)).alias("right2"),
    )


@query("replace_text", "SELECT p_partkey, replace(p_name, 'o', '0') AS replaced FROM part WHERE p_name LIKE '%o%'")
def _(t):
    return t.part.filter(F.col("p_name").like("%o%")).select(
        "p_partkey", F.replace(F.col("p_name"), F.lit("o"), F.lit("0")).alias("replaced")
    )


@query(
    "composite_code",
    """SELECT p_partkey, upper(left(p_name, 1)) || lower(substring(p_name, 2)) AS capitalised,
    'ID-' || replace(upper(p_name), ' ', '_') || '-' || p_size AS code FROM part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        fn.capitalise(F.col("p_name")).alias("capitalised"),
        fn.composite_code(F.col("p_name"), F.col("p_size")).alias("code"),
    )


@query("date_text", "SELECT o_orderkey, 'checked: ' || strftime(o_orderdate, '%Y-%m-%d') AS status FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.concat(F.lit("checked: "), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("status"))


@query("parse_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS iso, CAST(o_orderdate AS DATE) AS dotted FROM orders")
def _(t):
    iso, dotted = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "dd.MM.yyyy")
    return t.orders.select("o_orderkey", F.to_date(iso).alias("iso"), F.to_date(dotted, "dd.MM.yyyy").alias("dotted"))


@query(
    "null_propagation",
    """WITH o AS (SELECT o_orderkey, nullif(o_custkey, o_orderkey % 100) AS k, nullif(o_orderstatus, 'P') AS s FROM orders)
    SELECT o_orderkey, k + 5 AS plus, 10 * k AS times, 'status ' || s AS label FROM o""",
)
def _(t):
    key = F.nullif(F.col("o_custkey"), F.col("o_orderkey") % 100)
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select(
        "o_orderkey", (key + 5).alias("plus"), (key * 10).alias("times"), F.concat(F.lit("status "), status).alias("label")
    )


@query(
    "math_elementwise",
    """SELECT p_partkey, p_size ** 2 AS squared, round(sin(p_size), 8) AS sine, round(cos(p_size), 8) AS cosine,
    abs(p_size - 25) AS distance, abs(sin(p_size)) > abs(cos(p_size)) AS sine_larger FROM part""",
)
def _(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.pow(size, F.lit(2)).alias("squared"),
        F.round(F.sin(size), 8).alias("sine"),
        F.round(F.cos(size), 8).alias("cosine"),
        F.abs(size - 25).alias("distance"),
        (F.abs(F.sin(size)) > F.abs(F.cos(size))).alias("sine_larger"),
    )


@query("split_explode", "SELECT word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word")
def _(t):
    return word_rows(t.documents, "doc_id", "text").groupBy("word").agg(F.count("*").alias("n"))


@query(
    "split_expand",
    """SELECT p_partkey, codes, p_brand AS w0, CASE WHEN p_size % 4 >= 1 THEN p_type END AS w1,
    CASE WHEN p_size % 4 >= 2 THEN CAST(p_size AS VARCHAR) END AS w2, CASE WHEN p_size % 4 = 3 THEN 'x' END AS w3
    FROM (SELECT *, concat_ws('|', p_brand, CASE WHEN p_size % 4 >= 1 THEN p_type END, CASE WHEN p_size % 4 >= 2 THEN CAST(p_size AS VARCHAR) END,
      CASE WHEN p_size % 4 = 3 THEN 'x' END) AS codes FROM part)""",
)
def _(t):
    """One to four pieces a row; the widest row decides."""
    n = F.col("p_size") % 4
    codes = F.concat_ws("|", "p_brand", F.when(n >= 1, F.col("p_type")), F.when(n >= 2, F.col("p_size").cast("string")), F.when(n == 3, "x"))
    return split_expand(t.part.select("p_partkey", codes.alias("codes")), "codes", "|", "w")


@query(
    "split_expand_limited",
    """SELECT doc_id, split_part(text, ' ', 1) AS head,
    CASE WHEN strpos(text, ' ') > 0 THEN substr(text, strpos(text, ' ') + 1) END AS rest FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", *fn.split_columns(F.col("text"), " ", 2, ["head", "rest"], limit=2))


@query("nested_arith", "SELECT p_partkey, ((1 + p_size + 1) * 2) % 3 AS result FROM part")
def _(t):
    return t.part.select("p_partkey", (((1 + F.col("p_size") + 1) * 2) % 3).alias("result"))


@query("udf_row_apply", "SELECT p_partkey, p_size, p_retailprice, round(p_retailprice * p_size + 1, 4) AS applied FROM part")
def _(t):
    rows = t.part.select("p_partkey", "p_size", "p_retailprice")
    return rounded(row_apply(rows, lambda pdf: pdf.p_retailprice * pdf.p_size + 1, "applied", "double"), 4, "applied")


@query(
    "udf_group_apply",
    """SELECT p_partkey, p_type, CASE p_type WHEN 'ECONOMY' THEN p_size ** 2 WHEN 'SMALL' THEN p_size ** 3
    ELSE CAST(p_size AS DOUBLE) END AS amount FROM part""",
)
def _(t):
    rows = t.part.select("p_partkey", "p_type", F.col("p_size").cast("double").alias("amount"))
    return group_apply_rowwise(
        rows,
        "p_type",
        {"ECONOMY": lambda g: g.assign(amount=g.amount**2), "SMALL": lambda g: g.assign(amount=g.amount**3)},
    )


@query(
    "udf_whole_group",
    "SELECT p_partkey, p_type, round(p_retailprice - avg(p_retailprice) OVER (PARTITION BY p_type), 4) AS above_mean FROM part",
)
def _(t):
    """A function that needs all rows of its group: the distance to the group's mean."""

    def centre(group: pd.DataFrame) -> pd.DataFrame:
        return group.assign(above_mean=group.p_retailprice - group.p_retailprice.mean())[["p_partkey", "p_type", "above_mean"]]

    rows = t.part.select("p_partkey", "p_type", "p_retailprice")
    return rounded(group_apply(rows, ["p_type"], centre, "p_partkey long, p_type string, above_mean double"), 4)
