"""Joins, side-by-side concatenation and cardinality checks."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.filters import route
from tidewater.session import materialise

# A key with fewer rows than this is never worth spreading.
HOT_ROWS = 5_000_000
SALTS = 64
# Keys a sketch keeps for each one it may report; the more, the closer its counts.
TRACKED = 8
MOST_TRACKED = 1_000_000

_SKETCHED = (T.BooleanType, T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
_SALT, _POSITION, _HOT = "__salt", "__position", "__hot"


class JoinCardinalityError(ValueError):
    """The keys break the declared relation between the two sides."""


def _hot_items(rows: DataFrame, item: Column, hot_rows: int) -> DataFrame:
    """The values of ``item`` in more than ``hot_rows`` rows and more than an even share of them, as ``__item``."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(partitions, MOST_TRACKED // TRACKED)
    sketch = rows.agg(F.call_function("approx_top_k", item, F.lit(most), F.lit(TRACKED * most)).alias("top"), F.count("*").alias("n"))
    top = sketch.select("n", F.explode("top").alias("t")).select(F.col("t.item").alias("__item"), F.col("t.count").alias("__count"), "n")
    return top.where((F.col("__count") > hot_rows) & (F.col("__count") * partitions > F.col("n"))).select("__item")


def hot_hashes(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``xxhash64`` of the keys that ``hot_keys`` is about, as ``__item``; NULL is a value like any other."""
    return _hot_items(df.select(*keys), F.xxhash64(*keys), hot_rows)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys held by more than ``hot_rows`` rows and by more than a task's even share of all rows; none with a NULL.

    One pass over the key columns: every task counts frequent keys in a sketch of fixed size, and the sketches are merged.
    There are at most as many such keys as shuffle partitions, so the result may be broadcast. It is a frame like any
    other: nothing runs here. Keys of several columns, or of types without a sketch, are counted by hash and then looked
    up in a second pass over the key columns.
    """
    rows = df.select(*keys).dropna()
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, _SKETCHED):
        return _hot_items(rows, F.col(keys[0]), hot_rows).select(F.col("__item").alias(keys[0]))
    return rows.join(F.broadcast(hot_hashes(rows, keys, hot_rows)), F.xxhash64(*keys) == F.col("__item"), "left_semi").distinct()


def _positioned(df: DataFrame) -> DataFrame:
    """``df`` with its rows' places in the files that hold them: the same whenever and wherever a task runs again.

    Anything but a scan with filters and projections is written first; what is read twice is then computed once.
    """
    place = F.col("_metadata.row_index").alias(_POSITION)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if plan.count("Relation [") == 1 and not re.search(r"Join|Aggregate|Union|Generate|Window|Expand|Sample|Limit|Sort|Repartition|InMemory", plan):
        try:
            return df.select("*", place)
        except AnalysisException:  # not files that count their rows
            pass
    return materialise(df, "join-side").select("*", place)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Equi join on ``on`` (inner, left, right, full) that splits hot keys of either side over several tasks.

    AQE splits a skewed partition of either side of an inner join and of the side that an outer join keeps; those are left
    to it. For the other side of an outer join, and for both of a full one, rows of a hot key (``hot_keys``) get one of
    ``salts`` numbers by their place in the files, the opposite rows of that key are repeated once per number, and (key,
    number) becomes the join key. A hot key exists on its own side, so a repeated row has a partner under some number; its
    copies without one are by-products and removed. NULL keys match nothing and are spread by the same numbers.
    """
    salted_sides = {"inner": [], "left": ["right"], "right": ["left"], "full": ["left", "right"]}
    if how not in salted_sides:
        raise ValueError(f"unsupported join type {how}")
    if how == "inner":
        return left.join(right, on, how)
    frames = {"left": left, "right": right}
    for side in salted_sides[how]:
        frames[side] = _positioned(frames[side])
    tables = []
    for side in salted_sides[how]:
        found = hot_keys(frames[side], on, hot_rows)
        typed = [F.col(k).cast(left.schema[k].dataType) for k in on]
        # a value that the left type cannot hold has no partner there and needs no spreading
        for k, c in zip(on, typed):
            found = found.where(F.col(k) == c)
        tables.append(found.select(*[c.alias(k) for k, c in zip(on, typed)], F.lit(side).alias(_HOT)))
    hot = tables[0].unionByName(tables[-1]) if len(tables) == 2 else tables[0]
    # a key that is hot on both sides is spread on the right
    hot = F.broadcast(hot.groupBy(*on).agg(F.max(_HOT).alias(_HOT)))
    has_null = F.lit(False)
    for key in on:
        has_null = has_null | F.col(key).isNull()
    every = F.sequence(F.lit(0), F.lit(salts - 1))

    def salted(side: str) -> DataFrame:
        other = "right" if side == "left" else "left"
        salt = F.lit(0)
        if side in salted_sides[how]:
            number = F.pmod(F.col(_POSITION), F.lit(salts)).cast("int")
            salt = F.when((F.col(_HOT) == side) | has_null, number).otherwise(salt)
        if other in salted_sides[how]:
            salt = F.explode(F.when(F.col(_HOT) == other, every).otherwise(F.array(salt)))
        marked = frames[side].join(hot, on, "left").withColumn(_SALT, salt).drop(_POSITION)
        return marked.withColumnRenamed(_HOT, f"{_HOT}_{side}").withColumn(f"__in_{side}", F.lit(True))

    joined = salted("left").join(salted("right"), [*on, _SALT], how)
    by_product = F.lit(False)
    for side, other in (("left", "right"), ("right", "left")):
        by_product = by_product | (F.col(f"__in_{other}").isNull() & (F.col(f"{_HOT}_{side}") == other))
    helpers = [_SALT, *[f"{name}_{side}" for name in (_HOT, "__in") for side in frames]]
    return joined.filter(~F.coalesce(by_product, F.lit(False))).drop(*helpers)


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, how: str = "left") -> DataFrame:
    """Join (left, inner, left_semi, left_anti) with a table that has one row per key; ``df``'s key is kept.

    A second row of a key repeats rows of ``df``, as in any join. Hot and NULL keys of ``df`` make a large partition of the
    side that all four keep or filter, which AQE splits; the few lookup rows of that partition go to each part.
    """
    right = lookup.withColumnRenamed(lookup_key, "__key")
    return df.join(right, F.col(key) == F.col("__key"), how).drop("__key")


def _unique_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def semi(df: DataFrame, other: DataFrame, df_key: str, other_key: str) -> DataFrame:
    """Rows with a match. The other side is reduced to its distinct keys before the join."""
    return lookup_join(df, _unique_keys(other, other_key), df_key, other_key, "left_semi")


def anti(df: DataFrame, other: DataFrame, df_key: str, other_key: str) -> DataFrame:
    """Rows without a match; NULL keys count as unmatched."""
    return lookup_join(df, _unique_keys(other, other_key), df_key, other_key, "left_anti")


def semi_and_anti(df: DataFrame, other: DataFrame, df_key: str, other_key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a match, rows without): one join, written by branch; NULL keys count as unmatched."""
    known = _unique_keys(other, other_key).withColumn("__known", F.lit(True))
    with_match, without = route(lookup_join(df, known, df_key, other_key), F.col("__known").isNotNull())
    return with_match.drop("__known"), without.drop("__known")


def suffix_clashes(
    left: DataFrame, right: DataFrame, on: list[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> tuple[DataFrame, DataFrame]:
    """Both sides with clashing non-key names suffixed."""
    clashes = [c for c in left.columns if c in right.columns and c not in on]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in clashes}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in clashes}),
    )


def join_suffixed(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on common names; clashing other columns become ``_x`` and ``_y``."""
    l, r = suffix_clashes(left, right, on)
    return skew_join(l, r, on, how)


def join_on_names(left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "inner") -> DataFrame:
    """Join on keys of different names; both key columns stay.

    An inner join is left to AQE, which splits a skewed key of either side; it cannot do so for the side an
    outer join must keep whole.
    """
    if how == "inner":
        return left.join(right, left[left_on] == right[right_on])
    keyed = left.withColumn("__key", F.col(left_on)), right.withColumn("__key", F.col(right_on))
    return skew_join(*keyed, ["__key"], how).drop("__key")


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def join_validated(
    left: DataFrame, right: DataFrame, on: list[str], validate: str, how: str = "inner"
) -> DataFrame:
    """Join after checking ``1:1``, ``1:m`` or ``m:1``; ``m:m`` is not checked."""
    sides = {"1:1": (True, True), "1:m": (True, False), "m:1": (False, True), "m:m": (False, False)}
    long_names = {"one_to_one": "1:1", "one_to_many": "1:m", "many_to_one": "m:1", "many_to_many": "m:m"}
    checked = sides[long_names.get(validate, validate)]
    for unique, df, side in zip(checked, (left, right), ("left", "right")):
        if unique and not duplicated_keys(df, on).isEmpty():
            raise JoinCardinalityError(f"keys {on} repeat on the {side} side, relation {validate} does not hold")
    return join_suffixed(left, right, on, how)


def concat_columns(left: DataFrame, right: DataFrame, label: str, how: str = "full") -> DataFrame:
    """Side by side by label: ``full`` keeps all labels, ``inner`` the common ones."""
    return join_suffixed(left, right, [label], how)


def align_add(left: DataFrame, right: DataFrame, label: str, value: str) -> DataFrame:
    """Sum of two labelled vectors; a label of one side only gives NULL."""
    r = right.select(label, F.col(value).alias("__other"))
    return skew_join(left.select(label, value), r, [label], "full").select(
        label, (F.col(value) + F.col("__other")).alias(value)
    )


def with_scalar(df: DataFrame, source: DataFrame, aggregate: Column, name: str) -> DataFrame:
    """Adds one global aggregate of ``source`` to each row as a scalar subquery."""
    return df.withColumn(name, source.select(aggregate).scalar())


def cartesian(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of rows. For dimension tables: the result is the product of both sizes by definition."""
    return left.crossJoin(right)


def not_in(df: DataFrame, other: DataFrame, df_key: str, other_key: str) -> DataFrame:
    """SQL's NOT IN: nothing qualifies once ``other`` holds a NULL key, a NULL key never qualifies.

    Spark's own null-aware anti join must broadcast the whole list. Here one aggregate answers whether the list
    is empty or holds a NULL, and the rest is an ordinary anti join that can shuffle.
    """
    listed = other.agg(F.count("*").alias("n"), F.count_if(F.col(other_key).isNull()).alias("nulls")).first()
    if listed["n"] == 0:
        return df
    if listed["nulls"] > 0:
        return df.filter(F.lit(False))
    return anti(df.filter(F.col(df_key).isNotNull()), other, df_key, other_key)
