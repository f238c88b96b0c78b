"""Matrices as rows: coordinate rows ``(i, j, v)``, or one array per row id.

Element-wise work on array rows stays in one projection. The product of matrices with few cells is a join of the cells
by the inner index. Otherwise it works on square blocks: Spark places the pairs of blocks that are there, NumPy multiplies
the two blocks of a pair, by their cells or as dense arrays, and the partial products are summed by a grouped aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
# right operands up to this many cells are sent to every executor (16 bytes a cell: 64 MB)
BROADCAST_CELLS = 4_000_000
# Matrices of which less than this share is filled are multiplied cell by cell.
FILLED_SHARE = 0.01
# Two blocks of a pair are multiplied by their cells while these give fewer products than this share of the dense ones.
SPARSE_SHARE = 0.02


def to_coords(df: DataFrame, row_id: str, array: str) -> DataFrame:
    return df.select(F.col(row_id).cast("long").alias("i"), F.posexplode(array).alias("j", "v")).select(
        "i", F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v")
    )


def reduce_all(df: DataFrame, array: str) -> DataFrame:
    """Sum, mean, min and max over all cells, from per-row partial values (no explode)."""
    cells = F.transform(array, lambda v: v.cast("double"))
    rows = df.filter(F.size(array) > 0).select(
        F.aggregate(cells, F.lit(0.0), lambda a, v: a + v).alias("s"),
        F.size(array).alias("n"),
        F.array_min(cells).alias("lo"),
        F.array_max(cells).alias("hi"),
    )
    return rows.agg(
        F.sum("s").alias("sum"), (F.sum("s") / F.sum("n")).alias("mean"), F.min("lo").alias("min"), F.max("hi").alias("max")
    )


def reduce_columns(df: DataFrame, row_id: str, array: str) -> DataFrame:
    """Sum, mean, min and max per column (axis 0)."""
    return to_coords(df, row_id, array).groupBy("j").agg(
        F.sum("v").alias("sum"), F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max")
    )


def reduce_rows(df: DataFrame, row_id: str, array: str) -> DataFrame:
    """Sum, mean, min and max per row (axis 1): a projection, nothing is shuffled."""
    cells = F.transform(array, lambda v: v.cast("double"))
    total = F.aggregate(cells, F.lit(0.0), lambda a, v: a + v)
    return df.select(
        F.col(row_id).alias("i"),
        total.alias("sum"),
        (total / F.nullif(F.size(array), F.lit(0))).alias("mean"),
        F.array_min(cells).alias("min"),
        F.array_max(cells).alias("max"),
    )


def map_elements(df: DataFrame, array: str, functions: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One array column per function of the element."""
    return df.select("*", *[F.transform(array, f).alias(name) for name, f in functions.items()])


def combine_elements(df: DataFrame, left: str, right: str, f: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """Element by element over two array columns of one row."""
    return df.withColumn(name, F.zip_with(left, right, f))


def transpose(coords: DataFrame) -> DataFrame:
    return coords.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def _extent(coords: DataFrame) -> tuple[tuple[int, int], int]:
    """(shape, cells) in one pass."""
    rows, columns, cells = coords.agg(F.max("i"), F.max("j"), F.count("*")).first()
    return ((0, 0) if rows is None else (rows + 1, columns + 1)), cells


def shape(coords: DataFrame) -> tuple[int, int]:
    return _extent(coords)[0]


def reshape(coords: DataFrame, old: tuple[int, int], new: tuple[int, int]) -> DataFrame:
    """Row-major reshape; one -1 in ``new`` is inferred; a size that does not fit is an error."""
    cells = old[0] * old[1]
    known = -new[0] * new[1] if -1 in new else new[0] * new[1]
    if known <= 0 or cells % known or (-1 not in new and known != cells):
        raise ValueError(f"cannot reshape {old} to {new}")
    width = new[1] if new[1] != -1 else cells // new[0]
    place = F.col("i") * F.lit(old[1]) + F.col("j")
    return coords.select(
        F.call_function("div", place, F.lit(width).cast("long")).alias("i"),
        (place % F.lit(width)).cast("long").alias("j"),
        "v",
    )


def slice_block(
    coords: DataFrame,
    rows: tuple[int, int | None, int] = (0, None, 1),
    columns: tuple[int, int | None, int] = (0, None, 1),
) -> DataFrame:
    """Cells with start <= index < stop and a step, on both axes; the indexes are renumbered from 0."""
    kept = coords
    for axis, (start, stop, step) in (("i", rows), ("j", columns)):
        kept = kept.filter((F.col(axis) >= start) & ((F.col(axis) - start) % step == 0))
        if stop is not None:
            kept = kept.filter(F.col(axis) < stop)
    return kept.select(
        ((F.col("i") - rows[0]) / rows[2]).cast("long").alias("i"),
        ((F.col("j") - columns[0]) / columns[2]).cast("long").alias("j"),
        "v",
    )


def _blocks(coords: DataFrame, row: str, column: str, cells: str, block: int) -> DataFrame:
    """One row per block; a block holds at most block x block cells."""
    size = F.lit(block).cast("long")
    return (
        coords.groupBy(
            F.call_function("div", F.col("i"), size).alias(row), F.call_function("div", F.col("j"), size).alias(column)
        )
        .agg(F.collect_list(F.struct(((F.col("i") % size) * size + F.col("j") % size).cast("int").alias("p"), "v")).alias("c"))
        .select(row, column, F.col("c.p").alias(f"{cells}_p"), F.col("c.v").alias(f"{cells}_v"))
    )


def _by_cells(a: np.ndarray, a_v: np.ndarray, b: np.ndarray, b_v: np.ndarray, block: int, starts: np.ndarray, terms: np.ndarray):
    """Places and sums of all products of a cell of A with a cell of B; ``b`` is sorted, thus by row."""
    total = int(terms.sum())
    own = np.repeat(np.arange(len(a)), terms)
    other = np.repeat(starts - (np.cumsum(terms) - terms), terms) + np.arange(total)
    places, which = np.unique((a[own] // block) * block + b[other] % block, return_inverse=True)
    return places, np.bincount(which, weights=a_v[own] * b_v[other], minlength=len(places))


def _dense(a: np.ndarray, a_v: np.ndarray, b: np.ndarray, b_v: np.ndarray, block: int):
    """The same from the used rows, inner indices and columns as dense arrays."""
    rows, a_row = np.unique(a // block, return_inverse=True)
    columns, b_column = np.unique(b % block, return_inverse=True)
    inner = np.unique(np.concatenate((a % block, b // block)))
    a_at, b_at = (a_row, np.searchsorted(inner, a % block)), (np.searchsorted(inner, b // block), b_column)

    def product(left: np.ndarray, right: np.ndarray, kind: type) -> np.ndarray:
        x, y = np.zeros((len(rows), len(inner)), kind), np.zeros((len(inner), len(columns)), kind)
        x[a_at], y[b_at] = left, right
        return x @ y

    values = product(a_v, b_v, np.float64)
    if len(a) == len(rows) * len(inner) and len(b) == len(inner) * len(columns):
        there = np.ones(values.shape, bool)
    else:  # how many products a cell is the sum of; a sum of zero may have some
        there = product(np.ones(len(a)), np.ones(len(b)), np.float32) > 0
    i, j = np.nonzero(there)
    return rows[i] * block + columns[j], values[i, j]


def multiply_blocks(a: np.ndarray, a_v: np.ndarray, b: np.ndarray, b_v: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i * block + j`` and values of the product of two blocks given by places; only cells with a product."""
    order = np.argsort(b, kind="stable")
    b, b_v = b[order], b_v[order]
    starts, ends = np.searchsorted(b // block, a % block, "left"), np.searchsorted(b // block, a % block, "right")
    if (ends - starts).sum() < SPARSE_SHARE * block**3:
        return _by_cells(a, a_v, b, b_v, block, starts, ends - starts)
    return _dense(a, a_v, b, b_v, block)


def _multiply(block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                places, values = multiply_blocks(*(np.asarray(x) for x in (r.a_p, r.a_v, r.b_p, r.b_v)), block)
                yield pd.DataFrame({"i": places // block + r.bi * block, "j": places % block + r.bj * block, "v": values})

    return run


def matmul(
    a: DataFrame,
    b: DataFrame,
    block: int = BLOCK,
    broadcast_cells: int = BROADCAST_CELLS,
    check: bool = True,
    shapes: tuple[tuple[int, int], tuple[int, int]] | None = None,
    filled_share: float = FILLED_SHARE,
) -> DataFrame:
    """A (n x k) times B (k x m), both as coordinate rows with one row per cell; the inner sizes must agree.

    Sizes come from the largest stored index unless ``shapes`` gives them, as for matrices with empty last rows or
    columns. The result has a row for each cell with at least one product term, whatever the way.

    If neither matrix is filled to ``filled_share``, their cells meet by the inner index. Otherwise blocks do. A right operand
    of bounded, counted size goes to every executor, so A is not shuffled by the inner index at all. Beyond that the pairs
    of blocks that meet are found from the blocks' numbers alone, and the left and the right block of each are joined to it
    one after the other, by two numbers each, which spreads them even when the inner dimension is short.
    """
    (shape_a, cells_a), (shape_b, cells_b) = _extent(a), _extent(b)
    (n, inner_a), (inner_b, m) = shapes or (shape_a, shape_b)
    if check and inner_a != inner_b:
        raise ValueError(f"inner sizes differ: {n}x{inner_a} and {inner_b}x{m}")
    if cells_a < filled_share * n * inner_a and cells_b < filled_share * inner_b * m:
        cells = a.select("i", F.col("j").alias("k"), F.col("v").alias("a")).join(b.select(F.col("i").alias("k"), "j", F.col("v").alias("b")), "k")
        return cells.groupBy("i", "j").agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("v"))
    left, right = _blocks(a, "bi", "bk", "a", block), _blocks(b, "bk", "bj", "b", block)
    if cells_b <= broadcast_cells:
        pairs = left.join(F.broadcast(right), "bk")
    else:
        size = F.lit(block).cast("long")
        numbers = [
            frame.select(F.call_function("div", F.col("i"), size).alias(row), F.call_function("div", F.col("j"), size).alias(column)).distinct()
            for frame, row, column in ((a, "bi", "bk"), (b, "bk", "bj"))
        ]
        pairs = numbers[0].join(numbers[1], "bk").join(left, ["bi", "bk"]).join(right, ["bk", "bj"])
    partial = pairs.select("bi", "bj", "a_p", "a_v", "b_p", "b_v").mapInPandas(_multiply(block), "i long, j long, v double")
    return partial.groupBy("i", "j").agg(F.sum("v").alias("v"))


def add_column_vector(coords: DataFrame, vector: DataFrame) -> DataFrame:
    """Adds ``vector`` (i, v) to each column of the matrix; a matrix row without an entry is an error."""
    other = vector.select("i", F.col("v").alias("__add"), F.lit(True).alias("__there"))
    joined = coords.join(other, "i", "left")
    missing = F.assert_true(F.col("__there").isNotNull(), F.concat(F.lit("the vector has no entry "), F.col("i").cast("string")))
    return joined.select("i", "j", F.when(missing.isNull(), F.col("v") + F.col("__add")).alias("v"))


def stack_horizontal(left: DataFrame, right: DataFrame, left_columns: int) -> DataFrame:
    return left.unionByName(right.withColumn("j", F.col("j") + F.lit(left_columns).cast("long")))


def stack_vertical(top: DataFrame, bottom: DataFrame, top_rows: int) -> DataFrame:
    return top.unionByName(bottom.withColumn("i", F.col("i") + F.lit(top_rows).cast("long")))
