"""Row positions, slices, fills and ranks over data that no single task can hold.

The common step is ``bucketed``: splitters are taken from a sample of the order columns once and fixed, and a binary search
gives each row its bucket, in whichever pass it is read. What a bucket needs from the others is one small row per bucket,
found in a pass over the order columns, so nothing global runs in one task over the data itself and no copy of the rows is
written. Where a result is read several times in order, ``range_layout`` writes it once, partitioned and sorted.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.joins import hot_hashes
from tidewater.session import materialise

PART, ROW, TIE, BUCKET = "__part", "__row", "__tie", "__bucket"
# Buckets per shuffle partition, so that a partition gets several and their sizes even out; sampled rows per bucket.
BUCKETS_PER_PARTITION = 2
SAMPLED_PER_BUCKET = 32

# A group up to this many rows may be handled by one task; larger ones take the distributed way.
GROUP_BOUND = 5_000_000
# A prefix up to this many rows is taken by a top-n; only the plan depends on it.
TOP_ROWS = 10_000


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group: one aggregate over the key columns only."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")) if keys else df.agg(F.count("*").alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _sort_column(name: str, descending: bool) -> Column:
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_first()


def scan_ordered(df: DataFrame) -> DataFrame:
    """``df`` with rows in an order that a repeated task sees again, so that its rows can be numbered by position.

    Below a shuffle the order is that of arriving blocks and may change; such a plan is written first and numbered as
    it is read. A plan of scans and projections is left as it is.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return materialise(df, "ordered") if re.search("Exchange|InMemoryTableScan|ExistingRDD", plan) else df


def _laid_out(df: DataFrame, order_by: list[str], descending: bool = False) -> DataFrame:
    """``df`` range-partitioned and sorted, with partition and row numbers; not yet materialised.

    The scan position is the last sort key. It keeps the sort stable, and it lets rows that are equal in
    every ``order_by`` column fall into several partitions, so a value shared by a third of the rows
    does not make one huge task.
    """
    keys = [_sort_column(c, descending) for c in [*order_by, TIE]]
    number = F.monotonically_increasing_id()
    return (
        scan_ordered(df).withColumn(TIE, F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            *df.columns,
            F.shiftright(number, 33).cast("int").alias(PART),
            number.bitwiseAND(F.lit((1 << 33) - 1)).alias(ROW),
        )
    )


def range_layout(df: DataFrame, order_by: list[str], descending: bool = False) -> DataFrame:
    """``df`` in the given order, written once, with columns ``__part`` and ``__row``."""
    return materialise(_laid_out(df, order_by, descending), "layout")


def sort_rows(df: DataFrame, *keys: Column) -> DataFrame:
    """Stable global sort. The scan position as last key lets rows with equal keys fall into several tasks."""
    return scan_ordered(df).withColumn(TIE, F.monotonically_increasing_id()).orderBy(*keys, TIE).drop(TIE)


def bucketed(df: DataFrame, order_by: list[str]) -> DataFrame:
    """``df`` with its scan position and the number of the bucket that it falls into in ascending order, NULLs first.

    The scan position is the last sort key: it keeps the order stable, and it lets rows that are equal in every ``order_by``
    column fall into several buckets, so a value shared by a third of the rows does not make one huge task. The splitters are
    literals, a few for each shuffle partition, so that every pass over the frame sees the same buckets.
    """
    placed = scan_ordered(df).withColumn(TIE, F.monotonically_increasing_id())
    key = F.struct(*order_by, TIE)
    n = BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = placed.select(key.alias("k")).orderBy(F.xxhash64(f"k.{TIE}"), f"k.{TIE}").limit(n * SAMPLED_PER_BUCKET)
    sampled = sample.agg(F.array_sort(F.collect_list("k")).alias("k"))
    step = F.greatest(F.lit(1), F.floor(F.size("k") / n))
    fixed = sampled.select(F.filter("k", lambda _, i: (i > 0) & (i % step == 0)).alias("k")).first()["k"]
    kinds = [f.dataType for f in placed.select(*order_by, TIE).schema.fields]
    splitters = [F.struct(*[F.lit(v).cast(kind).alias(c) for v, kind, c in zip(row, kinds, [*order_by, TIE])]) for row in fixed]
    if not splitters:
        return placed.withColumn(BUCKET, F.lit(0))
    bounds = F.array(*splitters)
    # halvings for all splitters
    steps = F.array(*[F.lit(1 << k) for k in range(len(splitters).bit_length() - 1, -1, -1)])

    def halved(low: Column, half: Column) -> Column:
        """``low`` splitters are known not to lie above the row; are ``half`` more?"""
        return F.when(F.get(bounds, low + half - 1) <= key, low + half).otherwise(low)

    return placed.withColumn(BUCKET, F.aggregate(steps, F.lit(0), halved))


def _offsets(buckets: DataFrame, count: Column, descending: bool = False) -> DataFrame:
    """``__bucket, offset``: what ``count`` gives for all buckets before each; at most one row per bucket."""
    before = Window.orderBy(F.desc(BUCKET) if descending else F.asc(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    sizes = buckets.groupBy(BUCKET).agg(count.alias("size"))
    return sizes.select(BUCKET, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))


def with_positions(
    df: DataFrame,
    order_by: list[str],
    name: str = "pos",
    start: int = 0,
    descending: bool = False,
) -> DataFrame:
    """Adds consecutive numbers from ``start`` in the given order.

    Sizes per bucket (one row each, hence broadcast) from the order columns, then offset + row number in the bucket.
    """
    rows = bucketed(df, order_by)
    in_bucket = Window.partitionBy(BUCKET).orderBy(*[_sort_column(c, descending) for c in [*order_by, TIE]])
    offsets = F.broadcast(_offsets(rows.select(BUCKET), F.count("*"), descending))
    numbered = rows.withColumn(ROW, F.row_number().over(in_bucket)).join(offsets, BUCKET)
    return numbered.select(*df.columns, (F.col("offset") + F.col(ROW) + F.lit(start - 1)).cast("long").alias(name))


def concat_reset_index(frames: list[DataFrame], order_by: list[str], name: str = "index") -> DataFrame:
    """Rows of all frames under one new index 0..n-1; frame by frame, each in the given order."""
    tagged = [f.withColumn("__frame", F.lit(i)) for i, f in enumerate(frames)]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other)
    return with_positions(union, ["__frame", *order_by], name).drop("__frame")


def head(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[_sort_column(c, False) for c in order_by]).limit(n)


def tail(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """Last ``n`` rows: a top-n of the reversed order, no positions needed."""
    return df.orderBy(*[_sort_column(c, True) for c in order_by]).limit(n)


def slice_positions(
    df: DataFrame, order_by: list[str], start: int = 0, stop: int | None = None, step: int = 1, name: str = "pos"
) -> DataFrame:
    """Rows at positions start, start+step, ... below ``stop``; a negative step counts from the last row.

    The position of each row in the walked direction is kept as ``name``. A short prefix is a top-n of the order; nothing is
    sorted or written as a whole for it.
    """
    if step == 0:
        raise ValueError("step must not be 0")
    if stop is not None and stop <= TOP_ROWS:
        numbered = scan_ordered(df).withColumn(TIE, F.monotonically_increasing_id())
        keys = [_sort_column(c, step < 0) for c in [*order_by, TIE]]
        df = numbered.orderBy(*keys).limit(max(0, stop)).drop(TIE)
    placed = with_positions(df, order_by, name, descending=step < 0)
    wanted = (F.col(name) >= start) & ((F.col(name) - start) % abs(step) == 0)
    if stop is not None:
        wanted = wanted & (F.col(name) < stop)
    return placed.filter(wanted)


def slice_labels(df: DataFrame, label: str, low, high, columns: list[str] | None = None) -> DataFrame:
    """Label range with both ends included."""
    rows = df.filter(F.col(label).between(low, high))
    return rows.select(*columns) if columns else rows


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows, chosen by a seeded hash of the id: a top-n, the same rows on every run."""
    draw = F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed))))
    return df.orderBy(draw, F.col(id_col)).limit(n)


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def _fill(df: DataFrame, order_by: list[str], columns: list[str], keys: list[str], backward: bool) -> DataFrame:
    """Within a bucket a window takes the value; what reaches a bucket from those before it is one row."""
    rows = bucketed(df, [*keys, *order_by])
    key = F.struct(*[F.col(k) for k in keys] or [F.lit(0).alias("all")])
    place = F.struct(*order_by, TIE)
    # the key at a bucket's end, and of each column the value nearest to that end with its key
    farthest, nearest = (F.min, F.min_by) if backward else (F.max, F.max_by)
    seen = [F.when(F.col(c).isNotNull(), F.struct(key, place)) for c in columns]
    ends = rows.groupBy(BUCKET).agg(
        farthest(key).alias("end"), *[nearest(F.struct(key.alias("key"), F.col(c).alias("value")), at).alias(f"last_{i}") for i, (c, at) in enumerate(zip(columns, seen))]
    )
    in_order = F.desc(BUCKET) if backward else F.asc(BUCKET)
    so_far = Window.partitionBy("end").orderBy(in_order).rowsBetween(Window.unboundedPreceding, 0)
    of_end = [F.when(F.col(f"last_{i}.key").eqNullSafe(F.col("end")), F.col(f"last_{i}.value")) for i in range(len(columns))]
    reach = ends.select(BUCKET, "end", *[F.last(v, ignorenulls=True).over(so_far).alias(f"reach_{i}") for i, v in enumerate(of_end)])
    before = Window.orderBy(in_order)
    carry = reach.select(BUCKET, *[F.lag(c).over(before).alias(f"__{c}") for c in reach.columns[1:]])
    within = Window.partitionBy(BUCKET, *keys).orderBy(*[_sort_column(c, backward) for c in [*order_by, TIE]])
    within = within.rowsBetween(Window.unboundedPreceding, 0)
    carried = [F.when(key.eqNullSafe(F.col("__end")), F.col(f"__reach_{i}")) for i in range(len(columns))]
    filled = {c: F.coalesce(F.col(c), F.last(c, ignorenulls=True).over(within), carried[i]) for i, c in enumerate(columns)}
    return rows.join(F.broadcast(carry), BUCKET).select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def ffill(df: DataFrame, order_by: list[str], columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """NULLs take the last non-NULL value above, within ``keys`` when given."""
    return _fill(df, order_by, columns, keys or [], backward=False)


def bfill(df: DataFrame, order_by: list[str], columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """NULLs take the first non-NULL value below, within ``keys`` when given."""
    return _fill(df, order_by, columns, keys or [], backward=True)


def dense_rank_in_group(
    df: DataFrame, keys: list[str], value: str, name: str = "rank", group_bound: int = GROUP_BOUND
) -> DataFrame:
    """Dense rank of ``value`` per group: ties share a rank, no gaps, NULL values stay unranked.

    Groups beyond the bound that hold more than an even share of the rows (a sketch of the keys finds them in one pass) have
    their distinct values numbered bucket by bucket, and a value's rank is its distance from the group's first; a bucket is a
    part of a large group, so no task holds one. All other groups use the window function, in the same plan. Without large
    groups that is all there is.
    """
    hashed = F.xxhash64(*keys)
    ranked = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last()))
    large = hot_hashes(df, keys, group_bound)
    if large.isEmpty():
        return df.withColumn(name, F.when(F.col(value).isNotNull(), ranked))
    large = F.broadcast(large)
    small_rows = df.join(large, hashed == F.col("__item"), "left_anti")
    small = small_rows.withColumn(name, F.when(F.col(value).isNotNull(), ranked))

    large_rows = df.join(large, hashed == F.col("__item"), "left_semi")
    pairs = large_rows.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    placed = with_positions(pairs, [*keys, value], "__place")
    # as many rows as there are large groups
    first = placed.groupBy(*[F.col(k).alias(f"__f_{k}") for k in keys]).agg(F.min("__place").alias("__first"))
    ranks = placed.join(F.broadcast(first), [F.col(k).eqNullSafe(F.col(f"__f_{k}")) for k in keys]).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col(value).alias("__value"), (F.col("__place") - F.col("__first") + 1).cast("int").alias(name)
    )
    match = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [F.col(value) == F.col("__value")]
    return small.unionByName(large_rows.join(ranks, match, "left").select(*df.columns, name))


def row_labels(df: DataFrame, order_by: list[str], name: str = "row_label", prefix: str = "row ") -> DataFrame:
    """``row 1``, ``row 2``, ... in the given order."""
    placed = with_positions(df, order_by, "__n", start=1)
    return placed.withColumn(name, F.concat(F.lit(prefix), F.col("__n").cast("string"))).drop("__n")


def lag_growth_pct(counts: DataFrame, order_by: str, value: str) -> DataFrame:
    """Previous value and rounded change in percent, over rows that are already aggregated.

    The window has no partition key, so the input must be a small report such as one row per year.
    """
    previous = F.lag(value).over(Window.orderBy(order_by))
    return counts.withColumn("prev_count", previous).withColumn(
        "growth_pct", F.round((F.col(value) - F.col("prev_count")) / F.col("prev_count") * 100, 2)
    )
