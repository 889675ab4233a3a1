"""Exact quantiles of groups of any size by distributed selection.

Each wanted rank has a bracket [lo, hi] of values that holds it, at first the group's whole range. A pass finds pivots
in each open bracket (approximate quantiles, whose state is bounded), counts what lies between them, and takes over the
cell that holds the rank, until the bracket has few rows or one value. Pivots only decide how fast that goes: counts are
exact, and the least value of a bracket is always a cell of its own, so each pass gets on. No state grows with the number
of distinct values, and only cells that hold a wanted rank are looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import written

#: Rows of a bracket from which on it is sorted.
MOST = 100_000
CELLS = 64


def _same(keys: list[str], more: list[str] = ()) -> Column:
    cond = F.lit(True)
    for k in [*keys, *more]:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__b_{k}"))
    return cond


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"__b_{n}" for n in names})


def order_statistics(values: DataFrame, keys: list[str], whole: DataFrame, ranks: DataFrame, most: int = MOST) -> DataFrame:
    """(keys, rank, value): the value at each rank from 0.

    values: keys, x, w (how often); whole: keys, lo, hi, rows of each group; ranks: keys, rank, distinct.
    """
    brackets = ranks.join(_renamed(whole, keys), _same(keys)).select(*keys, "rank", "lo", "hi", F.lit(0).cast("long").alias("before"), "rows")
    wide = (F.col("lo") < F.col("hi")) & (F.col("rows") > most)
    if not whole.where(wide).limit(1).count():
        # Every group has few rows, or one value.
        upto = F.sum("w").over(W.partitionBy(*keys).orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow))
        placed = _renamed(values.groupBy(*keys, "x").agg(F.sum("w").alias("w")).withColumn("upto", upto), keys)
        return ranks.join(placed, _same(keys) & (F.col("rank") >= F.col("upto") - F.col("w")) & (F.col("rank") < F.col("upto"))).select(*keys, "rank", F.col("x").alias("value"))
    some_wide = 1
    while some_wide:
        open_ = brackets.where(wide)
        spans = _renamed(open_.select(*keys, "lo", "hi").distinct(), [*keys, "lo", "hi"])
        holds = _same(keys) & F.col("x").between(F.col("__b_lo"), F.col("__b_hi"))
        grid = [i / CELLS for i in range(1, CELLS)]
        pivots = values.join(spans, holds).groupBy(*keys, "__b_lo", "__b_hi").agg(F.percentile_approx("x", grid, 20 * CELLS).alias("found"))
        pivots = _renamed(written(pivots.withColumn("cuts", F.array_distinct(F.concat(F.array("__b_lo"), "found"))).drop("found"), "pivots"), keys)
        cell = F.size(F.filter("cuts", lambda c: c < F.col("x")))
        counts = values.join(pivots, holds).groupBy(*keys, "__b_lo", "__b_hi", cell.alias("cell")).agg(F.sum("w").alias("n"), F.count("*").alias("in_cell"), F.min("x").alias("least"), F.max("x").alias("greatest"))
        earlier = F.coalesce(F.sum("n").over(W.partitionBy(*keys, "__b_lo", "__b_hi").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        cells = _renamed(counts.withColumn("earlier", earlier), keys)
        inside = _same(keys, ["lo", "hi"]) & (F.col("rank") >= F.col("before") + F.col("earlier")) & (F.col("rank") < F.col("before") + F.col("earlier") + F.col("n"))
        closer = open_.join(cells, inside).select(*keys, "rank", F.col("least").alias("lo"), F.col("greatest").alias("hi"), (F.col("before") + F.col("earlier")).alias("before"), F.col("in_cell").alias("rows"))
        brackets = written(brackets.where(~wide).unionByName(closer), "brackets")
        some_wide = brackets.where(wide).limit(1).count()
    # Each bracket left has few rows, or one value.
    spans = _renamed(brackets.where("lo < hi").select(*keys, "lo", "hi", "before").distinct(), [*keys, "lo", "hi", "before"])
    some = values.join(spans, _same(keys) & F.col("x").between(F.col("__b_lo"), F.col("__b_hi"))).groupBy(*keys, "__b_lo", "__b_hi", "__b_before", "x").agg(F.sum("w").alias("w"))
    upto = F.sum("w").over(W.partitionBy(*keys, "__b_lo", "__b_hi").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)) + F.col("__b_before")
    placed = _renamed(some.withColumn("upto", upto), keys)
    found = brackets.where("lo < hi").join(placed, _same(keys, ["lo", "hi"]) & (F.col("rank") >= F.col("upto") - F.col("w")) & (F.col("rank") < F.col("upto"))).select(*keys, "rank", F.col("x").alias("value"))
    return brackets.where("not lo < hi").select(*keys, "rank", F.col("lo").alias("value")).unionByName(found)


def exact_quantiles(df: DataFrame, keys: list[str], x: str, quantiles, weight: str | None = None, most: int = MOST) -> DataFrame:
    """(keys, q, value): linear interpolation between the two ranks around q (n - 1); groups without values have no row.

    weight: how often a row counts. Nulls don't count; not-a-number is the greatest value.
    """
    names = keys or ["__all"]
    keyed = df if keys else df.withColumn("__all", F.lit(0))
    w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    values = keyed.select(*names, F.col(x).cast("double").alias("x"), w.alias("w")).where("x is not null and w > 0")
    whole = written(values.groupBy(*names).agg(F.sum("w").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("rows")), "groups")
    at = whole.select(*names, "n", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("q")).withColumn("at", F.col("q") * (F.col("n") - 1))
    sides = at.select(*names, "q", "at", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank"))
    found = _renamed(order_statistics(values, names, whole.drop("n"), sides.select(*names, "rank").distinct(), most), [*names, "rank"])
    met = sides.join(found, _same(names, ["rank"])).groupBy(*names, "q", "at")
    low, high = (F.min(F.struct("rank", "value")), F.max(F.struct("rank", "value")))
    out = met.agg(low.alias("low"), high.alias("high"))
    part = F.col("at") - F.col("low.rank")
    value = F.when(part == 0, F.col("low.value")).otherwise(F.col("low.value") * (1 - part) + F.col("high.value") * part)
    return out.select(*keys, "q", value.alias("value"))
