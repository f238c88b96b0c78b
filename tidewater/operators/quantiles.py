"""Exact quantiles beside other aggregates, overall or per group, that also work for a group no task can hold.

A quantile is the value at a rank of the sorted, counted values (or lies between two of them). Two scans of the input:

* The first takes the wanted aggregates, the sizes and a quantile sketch of every column per group, in one aggregate.
* The second depends on these. Many groups, none too large: the counted values are sorted by a window. A few large groups:
  the sketches bracket every wanted value, and the scan counts what lies below the brackets and keeps what lies inside, so
  that only the few values inside are shuffled and sorted. The brackets are checked, never trusted. Many groups with large
  ones among them: all counted values are range-partitioned, and only the partitions that hold a wanted rank are read again.

Values are sorted and counted in their own type; a NaN counts as missing. Everything is sorting and summing inside the
engine, which spills; the built-in exact percentiles hold one map of boxed values per group and percentile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import any_of, nan_to_null
from tidewater.operators.ordering import GROUP_BOUND, PART, range_layout
from tidewater.session import materialise

# Larger groups are worth being sorted by several tasks.
QUANTILE_BOUND = 100_000
# Brackets of more groups than this are not sent to every task.
BRACKET_GROUPS = 1_000
SKETCH_ACCURACY = 10_000
# A bracket reaches this share of the ranks to each side of the wanted one.
MARGIN = 2.0 / SKETCH_ACCURACY

SERIES, COUNT = "__s", "__n"


def _sorted_as(kind: T.DataType) -> T.DataType:
    """The type in which values of ``kind`` are sorted without loss."""
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    return T.DoubleType() if isinstance(kind, (T.FloatType, T.DoubleType)) else kind


@dataclass
class _Series:
    """One wanted quantile of one column."""

    column: int
    prob: float
    label: str


class _Job:
    """Input columns under internal names, and the wanted quantiles.

    Values of different types stand in different slots; a row of counted values fills the slot of its column's type.
    """

    def __init__(self, df: DataFrame, keys: list[str], columns: list[str], probs: dict[str, float], discrete: bool):
        self.keys, self.columns, self.probs, self.discrete = keys, columns, list(probs.values()), discrete
        self.group = [f"__k{i}" for i in range(len(keys))]
        self.values = [f"__v{i}" for i in range(len(columns))]
        self.types = [df.schema[c].dataType for c in columns]
        kinds = [_sorted_as(t) for t in self.types]
        self.kinds = list(dict.fromkeys(kinds))
        self.slot = [self.kinds.index(k) for k in kinds]
        self.slots = [f"__t{j}" for j in range(len(self.kinds))]
        self.series = [_Series(c, p, f"{columns[c]}_{label}") for c in range(len(columns)) for label, p in probs.items()]
        typed = [F.col(c).cast(k) for c, k in zip(columns, kinds)]
        typed = [nan_to_null(v) if isinstance(k, T.DoubleType) else v for v, k in zip(typed, kinds)]
        self.rows = df.select("*", *[F.col(k).alias(g) for k, g in zip(keys, self.group)], *[v.alias(n) for v, n in zip(typed, self.values)])

    def in_slots(self, column: int, value: Column) -> list[Column]:
        return [(value if j == self.slot[column] else F.lit(None)).cast(k).alias(s) for j, (s, k) in enumerate(zip(self.slots, self.kinds))]

    def ranks(self, prob: float, total: Column) -> tuple[Column, Column, Column]:
        """(lower rank, upper rank, weight of the upper value); ranks count from 1."""
        if self.discrete:
            rank = F.greatest(F.lit(1.0), F.ceil(F.lit(prob) * total).cast("double"))
            return rank, rank, F.lit(0.0)
        place = F.lit(prob) * (total - 1)
        return F.floor(place) + 1.0, F.ceil(place) + 1.0, place - F.floor(place)

    def targets(self, number: int, total: Column, before: Column) -> list[Column]:
        """The two ranks of a series among the values behind the first ``before``."""
        low, high, weight = self.ranks(self.series[number].prob, total)
        return [
            F.struct(F.lit(number).alias("q"), F.lit(is_high).alias("high"), weight.alias("weight"), (rank - before).alias("rank"))
            for is_high, rank in ((False, low), (True, high))
        ]

    def counted(self) -> DataFrame:
        """(group, column, value, rows): a frequent value becomes one row before any sort."""
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias(SERIES), *self.in_slots(c, F.col(v))) for c, v in enumerate(self.values)]))
        long = self.rows.select(*self.group, cells.alias("cell")).select(*self.group, "cell.*")
        known = any_of([F.col(s).isNotNull() for s in self.slots])
        return long.filter(known).groupBy(*self.group, SERIES, *self.slots).agg(F.count("*").alias(COUNT))

    def of_column(self, c: int) -> list[int]:
        return [i for i, s in enumerate(self.series) if s.column == c]


def _held_by_row() -> Column:
    """The targets that fall on this row: it stands for the ranks (upto - n, upto]."""
    upto, n = F.col("upto"), F.col(COUNT)
    return F.explode(F.filter("targets", lambda t: (t["rank"] <= upto) & (t["rank"] > upto - n))).alias("t")


def _by_window(job: _Job) -> DataFrame:
    one = Window.partitionBy(*job.group, SERIES)
    total, upto, n = F.col("total"), F.col("upto"), F.col(COUNT)
    # plain comparisons leave the few rows that hold a rank before any array is built
    holds = [(rank <= upto) & (rank > upto - n) for p in job.probs for rank in job.ranks(p, total)[:2]]
    targets = F.lit(None)
    for c in range(len(job.columns)):
        own = F.array(*[t for i in job.of_column(c) for t in job.targets(i, total, F.lit(0))])
        targets = F.when(F.col(SERIES) == c, own).otherwise(targets)
    return (
        job.counted()
        .withColumn("upto", F.sum(COUNT).over(one.orderBy(*job.slots)))
        .withColumn("total", F.sum(COUNT).over(one))
        .filter(any_of(holds))
        .withColumn("targets", targets)
        .select(*job.group, *job.slots, _held_by_row())
    )


def _joined(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``names``, NULL as a value."""
    other = right.withColumnsRenamed({name: f"p_{name}" for name in names})
    same = [F.col(name).eqNullSafe(F.col(f"p_{name}")) for name in names]
    return left.join(other, same, how).drop(*[f"p_{name}" for name in names])


def _by_range(job: _Job, counted: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` has one row of targets per group and series; their ranks refer to ``counted``."""
    laid = range_layout(counted, [*job.group, SERIES, *job.slots])
    series = [*job.group, SERIES]
    spans = (
        laid.groupBy(*series, PART)
        .agg(F.sum(COUNT).alias("size"))
        .withColumn("start", F.sum("size").over(Window.partitionBy(*series).orderBy(PART)) - F.col("size"))
    )
    moved = F.transform("targets", lambda t: t.withField("rank", t["rank"] - F.col("start")))
    here = (
        _joined(spans, plan, series)
        .select(*series, PART, F.filter(moved, lambda t: (t["rank"] >= 1) & (t["rank"] <= F.col("size"))).alias("targets"))
        .filter(F.size("targets") > 0)
    )
    running = F.sum(COUNT).over(Window.partitionBy(*series, PART).orderBy(*job.slots))
    joined = _joined(laid, here, [*series, PART])
    return joined.withColumn("upto", running).select(*job.group, *job.slots, _held_by_row())


def _by_series(job: _Job, counted: DataFrame, plan: DataFrame) -> DataFrame:
    series = [*job.group, SERIES]
    running = F.sum(COUNT).over(Window.partitionBy(*series).orderBy(*job.slots))
    joined = _joined(counted.withColumn("upto", running), plan, series)
    return joined.select(*job.group, *job.slots, _held_by_row())


def _first_scan(job: _Job, aggregates: list[Column]) -> DataFrame:
    """One row per group, written: the aggregates, ``__size``, and of each column the number of values and the brackets."""
    bounds = [b for p in job.probs for b in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))]
    parts = [F.count("*").alias("__size"), *aggregates]
    for v in job.values:
        parts += [F.count(v).alias(f"n{v}"), F.percentile_approx(v, bounds, SKETCH_ACCURACY).alias(f"b{v}")]
    return materialise(job.rows.groupBy(*job.group).agg(*parts), "quantile-groups")


def _inside_brackets(job: _Job, groups: DataFrame) -> tuple[DataFrame, DataFrame, int] | None:
    """(counted values inside the brackets, plan, most of them in one bracket); None when a bracket misses its value.

    The second scan. Each row counts for the brackets that it lies below, and is kept for those it lies in.
    """
    if job.group:
        brackets = F.broadcast(groups.select(*job.group, *[f"b{v}" for v in job.values]))
        rows = _joined(job.rows.select(*job.group, *job.values), brackets, job.group, "left")
        bounds = {v: F.col(f"b{v}") for v in job.values}
    else:
        known = groups.first()
        rows = job.rows.select(*job.values)
        bounds = {v: [F.lit(b) for b in known[f"b{v}"] or [None] * 2 * len(job.probs)] for v in job.values}
    below, inside = [], []
    for s in job.series:
        v, q = job.values[s.column], job.probs.index(s.prob)
        low, high = bounds[v][2 * q], bounds[v][2 * q + 1]
        # a bracket that reaches the first or last rank is open there
        under = F.lit(False) if s.prob <= MARGIN else F.col(v) < low
        over = F.lit(False) if s.prob >= 1 - MARGIN else F.col(v) > high
        below.append(under)
        inside.append(F.col(v).isNotNull() & ~under & ~over)
    cells = [F.when(hit, F.struct(F.lit(i).alias(SERIES), *job.in_slots(s.column, F.col(job.values[s.column])))) for i, (s, hit) in enumerate(zip(job.series, inside))]
    # few rows lie in a bracket: for the others no array is built
    kept = F.when(any_of(inside), F.filter(F.array(*cells), lambda c: c.isNotNull()))
    below_names = [f"__below{i}" for i in range(len(below))]
    marked = rows.select(*job.group, *[b.alias(n) for b, n in zip(below, below_names)], F.posexplode_outer(kept).alias("at", "cell"))
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    marked = marked.select(*job.group, *below_names, first.alias("__first"), "cell.*")
    found = materialise(
        marked.groupBy(*job.group, SERIES, *job.slots).agg(F.count("*").alias(COUNT), *[F.count_if(F.col("__first") & F.col(n)).alias(n) for n in below_names]),
        "quantile-brackets",
    )

    counted = found.where(F.col(SERIES).isNotNull()).select(*job.group, SERIES, *job.slots, COUNT)
    lower = found.groupBy(*job.group).agg(F.array(*[F.sum(n) for n in below_names]).alias("below"))
    held = counted.groupBy(*job.group, SERIES).agg(F.sum(COUNT).alias("held"), F.count("*").alias("distinct"))
    wanted = groups.select(*job.group, F.posexplode(F.array(*[F.col(f"n{job.values[s.column]}") for s in job.series])).alias(SERIES, "total"))
    if job.group:
        wanted = _joined(wanted, lower, job.group)
    else:
        wanted = wanted.crossJoin(lower)  # one row each
    wanted = wanted.where("total > 0").withColumn("before", F.element_at("below", F.col(SERIES) + 1))
    targets, missed = F.lit(None), F.lit(False)
    for i, s in enumerate(job.series):
        targets = F.when(F.col(SERIES) == i, F.array(*job.targets(i, F.col("total"), F.col("before")))).otherwise(targets)
        low, high, _ = job.ranks(s.prob, F.col("total"))
        outside = (low <= F.col("before")) | (high > F.col("before") + F.coalesce("held", F.lit(0)))
        missed = missed | ((F.col(SERIES) == i) & outside)
    series = [*job.group, SERIES]
    state = _joined(wanted, held, series, "left").agg(F.coalesce(F.bool_or(missed), F.lit(False)), F.coalesce(F.max("distinct"), F.lit(0))).first()
    return None if state[0] else (counted, wanted.select(*series, targets.alias("targets")), state[1])


def _whole_plan(job: _Job, groups: DataFrame) -> DataFrame:
    targets = [
        F.struct(F.lit(c).alias(SERIES), F.array(*[t for i in job.of_column(c) for t in job.targets(i, F.col(f"n{v}"), F.lit(0))]).alias("targets"))
        for c, v in enumerate(job.values)
    ]
    return groups.select(*job.group, F.explode(F.array(*targets)).alias("p")).select(*job.group, "p.*")


def _value(job: _Job, s: _Series) -> Column:
    """The value between the two that were found; a discrete one in the column's type, others as double."""
    slot = job.slot[s.column]
    low, high, kind = F.col(f"low{slot}"), F.col(f"high{slot}"), job.types[s.column]
    if job.discrete:
        return low.cast(kind)
    if isinstance(job.kinds[slot], T.LongType):  # the difference of two longs may not be one
        step = (high.cast("decimal(20,0)") - low.cast("decimal(20,0)")).cast("double")
    else:
        step = (high - low).cast("double")
    return low.cast("double") + step * F.col("weight")


def aggregate_with_quantiles(
    df: DataFrame,
    aggregates: list[Column],
    columns: list[str],
    probs: dict[str, float],
    keys: list[str],
    discrete: bool = False,
    group_bound: int = QUANTILE_BOUND,
    bracket_groups: int = BRACKET_GROUPS,
) -> DataFrame:
    """Ordinary aggregates and exact quantiles per group in two scans; columns ``<column>_<label>`` for the quantiles.

    Interpolated as a median is (a double), or ``discrete`` (an existing value, in the column's type). A NULL key is a group.
    """
    job = _Job(df, keys, columns, probs, discrete)
    groups = _first_scan(job, aggregates)
    sizes = groups.agg(F.max("__size").alias("largest"), F.count("*").alias("groups")).first()
    if (sizes["largest"] or 0) <= group_bound:
        found = _by_window(job)
    else:
        narrowed = _inside_brackets(job, groups) if sizes["groups"] <= bracket_groups else None
        if narrowed is None:
            found = _by_range(job, job.counted(), _whole_plan(job, groups))
        elif narrowed[2] <= GROUP_BOUND:
            found = _by_series(job, *narrowed[:2])
        else:
            found = _by_range(job, *narrowed[:2])
    ends = [F.max(F.when(F.col("t.high") == is_high, F.col(s))).alias(f"{name}{j}") for j, s in enumerate(job.slots) for name, is_high in (("low", False), ("high", True))]
    one = found.groupBy(*job.group, F.col("t.q").alias("q")).agg(*ends, F.max("t.weight").alias("weight"))
    wide = [F.max(F.when(F.col("q") == i, _value(job, s))).alias(s.label) for i, s in enumerate(job.series)]
    labels = [s.label for s in job.series]
    own = groups.drop("__size", *[f"{p}{v}" for v in job.values for p in "nb"])
    if not keys:
        # two one-row results
        return own.crossJoin(one.agg(*wide))
    joined = _joined(own, one.groupBy(*job.group).agg(*wide), job.group, "left")
    others = [c for c in own.columns if c not in job.group]
    return joined.select(*[F.col(g).alias(k) for g, k in zip(job.group, keys)], *others, *labels)


def quantiles(
    df: DataFrame,
    columns: list[str],
    probs: dict[str, float],
    keys: list[str] | None = None,
    discrete: bool = False,
    group_bound: int = QUANTILE_BOUND,
    bracket_groups: int = BRACKET_GROUPS,
) -> DataFrame:
    """Columns ``<column>_<label>`` per group; interpolated as a median is, or ``discrete`` (an existing value)."""
    return aggregate_with_quantiles(df, [], columns, probs, keys or [], discrete, group_bound, bracket_groups)
