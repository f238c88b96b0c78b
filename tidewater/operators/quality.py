"""Integrity rules as set-at-a-time jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.filters import holds_or_unknown, route
from tidewater.operators.joins import anti, lookup_join, semi, semi_and_anti
from tidewater.operators.ordering import with_positions


class ReferencedKeyError(ValueError):
    """A parent key is still referenced."""


def check_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One verdict row: rows, distinct keys, keys held more than once."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    verdict = F.when(F.count_if(F.col("n") > 1) == 0, "unique").otherwise("has duplicates")
    return per_key.agg(
        F.lit(",".join(keys)).alias("key"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_duplicated"),
        verdict.alias("verdict"),
    )


def check_foreign_key(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent; a NULL key passes."""
    return anti(child.filter(F.col(child_key).isNotNull()), parent, child_key, parent_key)


def insert_with_fk_gate(
    batch: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``reject_reason``), from one join that is written by branch."""
    keys = parent.select(parent_key).filter(F.col(parent_key).isNotNull()).distinct().withColumn("__known", F.lit(True))
    checked = lookup_join(batch, keys, child_key, parent_key)
    accepted, rejected = route(checked, F.col("__known").isNotNull() | F.col(child_key).isNull())
    return accepted.select(*batch.columns), rejected.select(*batch.columns, F.lit(f"{child_key} has no parent").alias("reject_reason"))


def delete_restrict(
    to_delete: DataFrame, child: DataFrame, parent_key: str, child_key: str
) -> tuple[DataFrame, DataFrame]:
    """(parents that may go, parents still referenced), from one join that is written by branch."""
    used, free = semi_and_anti(to_delete, child, parent_key, child_key)
    return free, used


def delete_cascade(child: DataFrame, deleted: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children left after their parents are deleted."""
    return anti(child, deleted, child_key, parent_key)


def delete_set_null(child: DataFrame, deleted: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children keep their row, keys of deleted parents become NULL."""
    gone = deleted.select(parent_key).filter(F.col(parent_key).isNotNull()).distinct().withColumn("__gone", F.lit(True))
    joined = lookup_join(child, gone, child_key, parent_key)
    return joined.select(
        *[F.when(F.col("__gone").isNull(), F.col(c)).alias(c) if c == child_key else F.col(c) for c in child.columns]
    )


def _replace_key(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``changes`` has one row (old_key, new_key) per changed key; two for one key are an error."""
    if not changes.groupBy("old_key").agg(F.count("*").alias("n")).filter(F.col("n") > 1).isEmpty():
        raise ValueError("a key is changed to two values")
    joined = lookup_join(df, changes.withColumn("__changed", F.lit(True)), key, "old_key")
    new = F.when(F.col("__changed"), F.col("new_key")).otherwise(F.col(key)).cast(df.schema[key].dataType)
    return joined.select(*[new.alias(c) if c == key else F.col(c) for c in df.columns])


def update_key(
    parent: DataFrame, child: DataFrame, changes: DataFrame, parent_key: str, child_key: str, mode: str = "restrict"
) -> tuple[DataFrame, DataFrame]:
    """(parent, child) after the key change: ``cascade`` carries it to the children, ``restrict`` refuses used keys.

    A new key that a parent outside the change already has would break the primary key, as would one given twice: an error.
    """
    renamed = _replace_key(parent.select(parent_key), changes, parent_key)
    new = changes.select(F.col("new_key").cast(parent.schema[parent_key].dataType).alias(parent_key)).distinct()
    taken = renamed.join(new, parent_key, "left_semi").groupBy(parent_key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    if not taken.isEmpty():
        raise ValueError(f"a new {parent_key} is already taken")
    if mode == "restrict":
        if not semi(changes, child, "old_key", child_key).isEmpty():
            raise ReferencedKeyError(f"{parent_key} values to be changed are still referenced by {child_key}")
        return _replace_key(parent, changes, parent_key), child
    if mode != "cascade":
        raise ValueError(f"unknown mode {mode}")
    return _replace_key(parent, changes, parent_key), _replace_key(child, changes, child_key)


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per required column with the number of rows that lack it; one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_missing")


def check_predicates(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the broken rules in ``violations``; NULL passes."""
    broken = F.concat_ws(",", *[F.when(~holds_or_unknown(rule), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("violations", broken).filter(F.col("violations") != "")


def check_type(df: DataFrame, column: str, type_name: str) -> DataFrame:
    """Rows whose value does not cast."""
    return df.filter(F.col(column).isNotNull() & F.col(column).try_cast(type_name).isNull())


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """NULLs take the column's default; columns absent from the batch are added."""
    present = [
        F.coalesce(F.col(c), F.lit(defaults[c])).cast(df.schema[c].dataType).alias(c) if c in defaults else F.col(c)
        for c in df.columns
    ]
    return df.select(*present, *[F.lit(v).alias(c) for c, v in defaults.items() if c not in df.columns])


def surrogate_key(
    batch: DataFrame, order_by: list[str], key: str, existing: DataFrame | None = None
) -> DataFrame:
    """Consecutive new keys in the given order, after the largest existing one; from 1 when there is none."""
    last = (existing.agg(F.max(key)).first()[0] or 0) if existing is not None else 0
    return with_positions(batch, order_by, key, start=last + 1)


def normalise_split(df: DataFrame, determinant: list[str], dependent: list[str]) -> tuple[DataFrame, DataFrame]:
    """(fact without the dependent columns, dimension of distinct determinant and dependent values).

    A determinant with two dependent values would multiply rows on the way back, so it is an error.
    """
    dimension = df.select(*determinant, *dependent).distinct()
    clashes = dimension.groupBy(*determinant).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    if not clashes.isEmpty():
        raise ValueError(f"{dependent} are not determined by {determinant}")
    return df.drop(*dependent), dimension


def normalise_join(fact: DataFrame, dimension: DataFrame, determinant: list[str]) -> DataFrame:
    """The table before ``normalise_split``: a NULL determinant finds its row, too, so no row is lost."""
    other = dimension.withColumnsRenamed({c: f"__{c}" for c in determinant})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in determinant]
    return fact.join(other, same, "left").drop(*[f"__{c}" for c in determinant])
