"""Total orders without a single task: range partitions, sums before each of them, and state carried into them.

A table is dealt into ranges of its order and written once, for bounds are sampled and all later steps must see the same
ones. What a range needs from earlier or later ones is a summary of a row for each range (or for each range and episode,
where an episode goes on in the next range), so a hot episode is as many tasks as it fills ranges.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..scratch import written

PART = "__part"


def dealt(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """df with ``__part``, the number of its row's range of the order; equal rows are in one range."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()), "ranges")


def sums_before(ranges: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """(__part and, for each name, the sum over all earlier ranges): a row for each range, added up on the driver."""
    per = ranges.groupBy(PART).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    rows = sorted(per.collect(), key=lambda r: r[PART])  # as many rows as there are ranges, a parameter
    before = {name: [0, *accumulate(r[name] or 0 for r in rows)] for name in sums}
    schema = StructType([StructField(PART, IntegerType()), *[per.schema[name] for name in sums]])
    as_type = {name: float if per.schema[name].dataType.typeName() == "double" else (lambda v: v) for name in sums}
    made = [(r[PART], *[as_type[name](before[name][i]) for name in sums]) for i, r in enumerate(rows)]
    return ranges.sparkSession.createDataFrame(made, schema)


def running_sums(df: DataFrame, order: list[str], sums: dict[str, Column], parts: int | None = None) -> DataFrame:
    """df and, for each name, the sum of its column up to and with the row, in a total order."""
    ranges = dealt(df.withColumns({f"__v_{name}": c for name, c in sums.items()}), order, parts)
    before = sums_before(ranges, {f"__b_{name}": F.col(f"__v_{name}") for name in sums})
    upto = W.partitionBy(PART).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = ranges.withColumns({name: F.sum(f"__v_{name}").over(upto) for name in sums}).join(F.broadcast(before), PART)
    return inside.withColumns({name: F.col(name) + F.col(f"__b_{name}") for name in sums}).drop(PART, *[f"__v_{n}" for n in sums], *[f"__b_{n}" for n in sums])


class Spread:
    """A table of episodes dealt into ranges of (episode, order), for windows over episodes of any length.

    Each method gives a column function's value for all rows as a new column: what lies in the row's own range by a
    window there, what lies outside by the ranges' summaries. Rows of an episode have to differ in their order.
    """

    def __init__(self, df: DataFrame, episode: list[str], order: list[str], parts: int | None = None):
        self.episode, self.order = list(episode), list(order)
        self.df = dealt(df, [*self.episode, *self.order], parts)
        self.within = W.partitionBy(PART, *self.episode).orderBy(*self.order)
        self.back = W.partitionBy(PART, *self.episode).orderBy(*[F.desc(o) for o in self.order])
        self._wanted: dict[str, tuple[Column, Column, str]] = {}

    def _add(self, name: str, local: Column, kept: Column, side: str) -> Spread:
        """local: the value within the range; kept: the range's contribution; side: 'before' takes the last such, 'after' the first."""
        self._wanted[name] = (local, kept, side)
        return self

    def _edge(self, value: Column, pick, valid: Column | None = None) -> Column:
        at = F.struct(*self.order, value.alias("__x"))
        return pick(F.when(valid, at) if valid is not None else at)

    def lag(self, name: str, x: Column) -> Spread:
        """x at the row before, boxed, so that a null before differs from no row; see ``unboxed``."""
        box = F.struct(x.alias("__x"))
        return self._add(name, F.lag(box).over(self.within), self._edge(box, F.max), "before")

    def lead(self, name: str, x: Column) -> Spread:
        """x at the row after, boxed."""
        box = F.struct(x.alias("__x"))
        return self._add(name, F.lead(box).over(self.within), self._edge(box, F.min), "after")

    def last(self, name: str, x: Column, here: bool = True) -> Spread:
        """The last x that isn't null up to the row (with it, if here)."""
        frame = self.within.rowsBetween(W.unboundedPreceding, W.currentRow if here else -1)
        return self._add(name, F.last(x, ignorenulls=True).over(frame), self._edge(x, F.max, x.isNotNull()), "before")

    def next(self, name: str, x: Column) -> Spread:
        """The first x that isn't null from the row on."""
        frame = self.back.rowsBetween(W.unboundedPreceding, W.currentRow)
        return self._add(name, F.last(x, ignorenulls=True).over(frame), self._edge(x, F.min, x.isNotNull()), "after")

    def rows(self) -> DataFrame:
        """The table with all columns asked for."""
        names = list(self._wanted)
        parts = self.df.groupBy(PART, *self.episode).agg(*[kept.alias(n) for n, (_, kept, _) in self._wanted.items()])
        # Only the episodes that lie in several ranges have anything to carry: at most two of them in a range.
        counted = parts.withColumn("__ranges", F.count("*").over(W.partitionBy(*self.episode))).where("__ranges > 1").drop("__ranges")
        before = W.partitionBy(*self.episode).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
        after = W.partitionBy(*self.episode).orderBy(F.desc(PART)).rowsBetween(W.unboundedPreceding, -1)
        carried = counted.select(PART, *self.episode, *[F.last(n, ignorenulls=True).over(before if self._wanted[n][2] == "before" else after).alias(f"__c_{n}") for n in names])
        carried = carried.select(F.col(PART).alias("__of"), *[F.col(e).alias(f"__e_{e}") for e in self.episode], *[f"__c_{n}" for n in names])
        local = self.df.withColumns({n: w[0] for n, w in self._wanted.items()})
        same = F.col(PART) == F.col("__of")
        for e in self.episode:
            same = same & F.col(e).eqNullSafe(F.col(f"__e_{e}"))
        out = local.join(F.broadcast(carried), same, "left")  # at most two rows for each range, a parameter
        return out.withColumns({n: F.coalesce(F.col(n), F.col(f"__c_{n}.__x")) for n in names}).drop(PART, "__of", *[f"__e_{e}" for e in self.episode], *[f"__c_{n}" for n in names])


def unboxed(name: str) -> Column:
    return F.col(f"{name}.__x")


def long_forward_delta(df: DataFrame, episode: list[str], order: list[str], x: str, name: str = "delta", parts: int | None = None) -> DataFrame:
    """df and x[t+1] - x[t], 0 at the last frame; an episode may be of any length."""
    out = Spread(df, episode, order, parts).lead("__next", F.col(x)).rows()
    return out.withColumn(name, F.coalesce(unboxed("__next") - F.col(x), F.lit(0.0))).drop("__next")


def long_binarize_gripper(df: DataFrame, episode: list[str], order: list[str], x: str, high: float = 0.95, low: float = 0.05, name: str = "grip", parts: int | None = None) -> DataFrame:
    """df and 1 above high, 0 below low; between, the state reached next; after the last such, the episode's last raw value."""
    state = F.when(F.col(x) > high, F.lit(1.0)).when(F.col(x) < low, F.lit(0.0))
    ends = Spread(df, episode, order, parts).next("__state", state).lead("__after", F.lit(1))
    last = F.when(F.col("__after").isNull(), F.struct(F.col(x).alias("v")))
    out = Spread(ends.rows(), episode, order, parts).next("__end", last).rows()
    return out.withColumn(name, F.coalesce("__state", "__end.v")).drop("__state", "__after", "__end")


def long_absolute_gripper(df: DataFrame, episode: list[str], order: list[str], x: str, threshold: float = 0.1, name: str = "grip", parts: int | None = None) -> DataFrame:
    """df and the relative moves as 1 open, 0 closed, carried forward; before the first move its opposite."""
    move = F.when(F.col(x) < -threshold, F.lit(1.0)).when(F.col(x) > threshold, F.lit(-1.0))
    # Before the first move nothing is carried, so the next move is the first one.
    out = Spread(df, episode, order, parts).last("__moved", move).next("__first", move).rows()
    return out.withColumn(name, F.coalesce(F.col("__moved"), -F.col("__first"), F.lit(1.0)) / 2.0 + 0.5).drop("__moved", "__first")


def long_noops(df: DataFrame, episode: list[str], order: list[str], arm: Column, gripper: Column, threshold: float = 1e-4, name: str = "noop", parts: int | None = None) -> DataFrame:
    """df and whether the arm rests and the gripper is as before (or nothing has moved yet)."""
    made = df.withColumns({"__rests": arm < threshold, "__grip": gripper})
    moved = F.when(~F.col("__rests"), F.lit(1))
    out = Spread(made, episode, order, parts).last("__moved", moved, here=False).lag("__was", F.col("__grip")).rows()
    return out.withColumn(name, F.col("__rests") & (F.col("__moved").isNull() | (F.col("__grip") == unboxed("__was")))).drop("__rests", "__grip", "__moved", "__was")


def long_nearest(source: DataFrame, query: DataFrame, key: list[str], t: str, values: list[str], tie: str = "earlier", parts: int | None = None) -> DataFrame:
    """query with source_t and values of the nearest sample; beyond the ends, the end's; keys may have any number of rows."""
    sample = F.struct(F.col(t).alias("t"), *[F.col(v).alias(v) for v in values])
    rest = [c for c in query.columns if c not in (*key, t)]
    s = source.select(*key, t, F.lit(0).alias("__q"), F.monotonically_increasing_id().alias("__i"), sample.alias("__s"), *[F.lit(None).cast(query.schema[c].dataType).alias(c) for c in rest])
    q = query.select(*key, t, F.lit(1).alias("__q"), F.monotonically_increasing_id().alias("__i"), F.lit(None).cast(s.schema["__s"].dataType).alias("__s"), *rest)
    out = Spread(s.unionByName(q), key, [t, "__q", "__i"], parts).last("__p", F.col("__s")).next("__n", F.col("__s")).rows().where("__q = 1")
    p, n = F.col("__p"), F.col("__n")
    left = F.col(t) - p["t"] <= n["t"] - F.col(t) if tie == "earlier" else F.col(t) - p["t"] < n["t"] - F.col(t)
    best = F.when(n.isNull() | (p.isNotNull() & left), p).otherwise(n)
    return out.withColumn("__b", best).select(*key, t, *rest, F.col("__b.t").alias(f"source_{t}"), *[F.col(f"__b.{v}").alias(v) for v in values])
