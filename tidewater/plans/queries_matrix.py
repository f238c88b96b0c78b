"""Matrix work over the ``embeddings`` table: one array of 64 numbers per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import matrix
from tidewater.plans.registry import query, rounded

CELLS_SQL = """WITH cells AS (SELECT vec_id AS i, CAST(unnest(generate_series(0, len(embedding) - 1)) AS BIGINT) AS j,
    CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
"""
WIDTH = 64


def cells(t):
    return matrix.to_coords(t.embeddings, "vec_id", "embedding")


def _stats(name: str, idx: str) -> str:
    return f"SELECT '{name}' AS axis, {idx} AS idx, round(sum(v), 5) AS sum, round(avg(v), 6) AS mean, round(min(v), 6) AS min, round(max(v), 6) AS max FROM cells"


@query(
    "axis_sum",
    CELLS_SQL + _stats("all", "-1") + " UNION ALL " + _stats("columns", "j") + " GROUP BY j UNION ALL " + _stats("rows", "i") + " GROUP BY i",
)
def _(t):
    e = t.embeddings
    parts = {
        "all": matrix.reduce_all(e, "embedding").withColumn("idx", F.lit(-1).cast("long")),
        "columns": matrix.reduce_columns(e, "vec_id", "embedding").withColumnRenamed("j", "idx"),
        "rows": matrix.reduce_rows(e, "vec_id", "embedding").withColumnRenamed("i", "idx"),
    }
    result = None
    for axis, df in parts.items():
        df = df.select(F.lit(axis).alias("axis"), "idx", F.round("sum", 5).alias("sum"),
                       *[F.round(c, 6).alias(c) for c in ("mean", "min", "max")])
        result = df if result is None else result.unionByName(df)
    return result


@query(
    "elementwise_map",
    CELLS_SQL
    + """SELECT i, round(sum(v + 1), 5) AS plus1, round(sum(v * 2), 5) AS times2, round(sum(v ** 2), 6) AS squared,
    round(sum(v + v ** 2), 6) AS plus_square, round(sum(v * v ** 2), 6) AS cubed FROM cells GROUP BY i""",
)
def _(t):
    e = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    mapped = matrix.map_elements(e, "v", {"plus1": lambda v: v + 1, "times2": lambda v: v * 2, "squared": lambda v: v * v})
    mapped = matrix.combine_elements(mapped, "v", "squared", lambda a, b: a + b, "plus_square")
    mapped = matrix.combine_elements(mapped, "v", "squared", lambda a, b: a * b, "cubed")

    def total(c, digits):
        return F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), digits).alias(c)

    return mapped.select(
        F.col("vec_id").alias("i"), total("plus1", 5), total("times2", 5), *[total(c, 6) for c in ("squared", "plus_square", "cubed")]
    )


@query("transpose_coords", CELLS_SQL + "SELECT j AS i, i AS j, round(v, 6) AS v FROM cells")
def _(t):
    return rounded(matrix.transpose(cells(t)), 6)


@query("reshape_coords", CELLS_SQL + "SELECT (i * 64 + j) // 32 AS i, (i * 64 + j) % 32 AS j, round(v, 6) AS v FROM cells")
def _(t):
    coords = cells(t)
    return rounded(matrix.reshape(coords, matrix.shape(coords), (-1, 32)), 6)


@query("slice_matrix", CELLS_SQL + "SELECT i, (j - 8) // 4 AS j, round(v, 6) AS v FROM cells WHERE j >= 8 AND j < 40 AND (j - 8) % 4 = 0")
def _(t):
    return rounded(matrix.slice_block(cells(t), columns=(8, 40, 4)), 6)


CENTRES_SQL = ", centres AS (SELECT label AS k, j, avg(v) AS v FROM cells JOIN embeddings ON vec_id = i GROUP BY 1, 2)"


def label_centres(t):
    """Mean vector per label as a 64 x labels matrix."""
    labelled = cells(t).join(t.embeddings.select(F.col("vec_id").alias("i"), F.col("label").cast("long").alias("label")), "i")
    return labelled.groupBy("j", "label").agg(F.avg("v").alias("v")).select(F.col("j").alias("i"), F.col("label").alias("j"), "v")


MATMUL_SQL = (
    CELLS_SQL
    + CENTRES_SQL
    + " SELECT cells.i AS i, CAST(centres.k AS BIGINT) AS j, round(sum(cells.v * centres.v), 6) AS v FROM cells JOIN centres USING (j) GROUP BY 1, 2"
)


@query("matmul", MATMUL_SQL)
def _(t):
    """Every vector times every label centre."""
    return rounded(matrix.matmul(cells(t), label_centres(t)), 6)


@query("matmul_shuffled", MATMUL_SQL)
def _(t):
    """The same product by the way taken when the right operand is too large to broadcast."""
    return rounded(matrix.matmul(cells(t), label_centres(t), broadcast_cells=0), 6)


@query(
    "matmul_gram",
    CELLS_SQL + "SELECT a.j AS i, b.j AS j, round(sum(a.v * b.v), 6) AS v FROM cells a JOIN cells b USING (i) GROUP BY 1, 2",
)
def _(t):
    """Transposed matrix times the matrix: the sum runs over all vectors."""
    coords = cells(t)
    return rounded(matrix.matmul(matrix.transpose(coords), coords, broadcast_cells=0), 6)


@query("broadcast_add", CELLS_SQL + "SELECT i, j, round(v + i, 6) AS v FROM cells")
def _(t):
    vector = t.embeddings.select(F.col("vec_id").alias("i"), F.col("vec_id").cast("double").alias("v"))
    return rounded(matrix.add_column_vector(cells(t), vector), 6)


@query(
    "mask_and_count",
    CELLS_SQL + "SELECT count(*) AS n_cells, CAST(count_if(v > 0) AS BIGINT) AS n_positive, CAST(count_if(abs(sin(v * 40)) > abs(cos(v * 40))) AS BIGINT) AS n_sine FROM cells",
)
def _(t):
    v = F.col("v")
    return cells(t).agg(
        F.count("*").alias("n_cells"),
        F.count_if(v > 0).alias("n_positive"),
        F.count_if(F.abs(F.sin(v * 40)) > F.abs(F.cos(v * 40))).alias("n_sine"),
    )


@query("mask_select", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity % 2 = 0")
def _(t):
    return t.lineitem.filter(F.col("l_quantity") % 2 == 0).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "stack_matrices",
    CELLS_SQL
    + """SELECT 'h' AS kind, i, j, round(v, 6) AS v FROM cells UNION ALL SELECT 'h', i, j + 64, round(v * v, 6) FROM cells
    UNION ALL SELECT 'v', i, j, round(v, 6) FROM cells UNION ALL SELECT 'v', i + n, j, round(v * v, 6) FROM cells, (SELECT max(vec_id) + 1 AS n FROM embeddings)""",
)
def _(t):
    coords = cells(t)
    squares = coords.withColumn("v", F.col("v") * F.col("v"))
    rows, columns = matrix.shape(coords)
    h = matrix.stack_horizontal(coords, squares, columns).withColumn("kind", F.lit("h"))
    v = matrix.stack_vertical(coords, squares, rows).withColumn("kind", F.lit("v"))
    return rounded(h.unionByName(v), 6)
