"""Statistics of features: by episode, merged, global, by histogram, and their comparison.

Moments are partial sums that combine in any order (count, sum, sum of squares; merged ones about the merged mean); quantiles are
exact: by episode from Spark's own percentile, which merges value counts map-side, of whole datasets by selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import selection

QUANTILES = (0.01, 0.10, 0.50, 0.90, 0.99)


def _aggregates(x: Column, quantiles) -> list[Column]:
    q = F.percentile(x, [float(v) for v in quantiles])
    return [
        F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.count(x).alias("count"),
        *[F.get(q, F.lit(i)).alias(f"q{round(100 * v):02d}") for i, v in enumerate(quantiles)],
    ]


def feature_stats(df: DataFrame, keys: list[str], x: str, quantiles=QUANTILES) -> DataFrame:
    """keys and min, max, mean, std (population), count and quantiles (linear) of a scalar."""
    return df.groupBy(*keys).agg(*_aggregates(F.col(x).cast("double"), quantiles))


def global_stats(df: DataFrame, keys: list[str], x: str, quantiles=QUANTILES, most: int = selection.MOST) -> DataFrame:
    """feature_stats of groups of any size: nothing that is kept grows with the number of distinct values."""
    v = F.col(x).cast("double")
    names = keys or ["__all"]
    keyed = df if keys else df.withColumn("__all", F.lit(0))
    moments = keyed.groupBy(*names).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.count(v).alias("count"))
    found = selection.exact_quantiles(keyed, names, x, quantiles, most=most)
    wide = found.groupBy(*[F.col(n).alias(f"__k_{n}") for n in names]).agg(*[F.max(F.when(F.col("q") == float(q), F.col("value"))).alias(f"q{round(100 * q):02d}") for q in quantiles])
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"__k_{n}"))
    return moments.join(wide, same, "left").drop("__all", *[f"__k_{n}" for n in names])


def vector_stats(df: DataFrame, keys: list[str], v: str, quantiles=QUANTILES) -> DataFrame:
    """feature_stats of each dimension: keys, dim (from 0) and the statistics."""
    long = df.select(*keys, F.posexplode(v).alias("dim", "__x"))
    return feature_stats(long, [*keys, "dim"], "__x", quantiles)


def merge_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """min, max, mean, std and count of groups from those of their parts. Quantiles don't merge: recompute them."""
    # Squares about the group's own mean: about zero they lose their digits where the mean is large against the deviation.
    by = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    means = stats.groupBy(*keys).agg((F.sum(F.col("count") * F.col("mean")) / F.sum("count")).alias("__mean"))
    means = means.select(*[F.col(k).alias(f"__{k}") for k in keys], "__mean")
    n, m, s = F.col("count"), F.col("mean"), F.col("std")
    away = m - F.col("__mean")
    second = F.sum(n * (s * s + away * away)) / F.sum("count")
    joined = stats.join(means, by) if keys else stats.join(F.broadcast(means))  # without keys: one row
    return joined.groupBy(*keys).agg(F.min("min").alias("min"), F.max("max").alias("max"), F.first("__mean").alias("mean"), F.sqrt(second).alias("std"), F.sum("count").alias("count"))


def value_histogram(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """keys, value, n"""
    return df.groupBy(*keys, F.col(x).alias("value")).agg(F.count("*").alias("n"))


def histogram_quantiles(histogram: DataFrame, keys: list[str], quantiles=(0.01, 0.5, 0.99)) -> DataFrame:
    """keys, q, value: linear interpolation between the two ranks around q (n - 1), from values and their counts."""
    return selection.exact_quantiles(histogram, keys, "value", quantiles, weight="n")


def is_close(a: Column, b: Column, rtol: float = 5e-6, atol: float = 6e-5) -> Column:
    return F.abs(a - b) <= atol + rtol * F.abs(b)


def compare_stats(left: DataFrame, right: DataFrame, keys: list[str], names=("min", "max", "mean", "std"), rtol: float = 5e-6, atol: float = 6e-5) -> DataFrame:
    """keys, in_left, in_right, and for each statistic whether both agree; a missing side is a disagreement."""
    a = left.select(*keys, F.lit(True).alias("__l"), *[F.col(n).alias(f"__l_{n}") for n in names])
    b = right.select(*keys, F.lit(True).alias("__r"), *[F.col(n).alias(f"__r_{n}") for n in names])
    j = a.join(b, keys, "full")
    checks = [F.coalesce(is_close(F.col(f"__l_{n}"), F.col(f"__r_{n}"), rtol, atol), F.lit(False)).alias(f"{n}_ok") for n in names]
    return j.select(*keys, F.coalesce("__l", F.lit(False)).alias("in_left"), F.coalesce("__r", F.lit(False)).alias("in_right"), *checks)


def tasks_by_episode(df: DataFrame, episode: str, task: str, order: str) -> DataFrame:
    """episode, tasks: its distinct tasks by first appearance."""
    first = df.groupBy(episode, task).agg(F.min(order).alias("__o"))
    return first.groupBy(episode).agg(F.transform(F.sort_array(F.collect_list(F.struct("__o", task))), lambda x: x[task]).alias("tasks"))


def contiguity(df: DataFrame, index: str) -> DataFrame:
    """One row: n, least, greatest, contiguous: whether the distinct values are 0 to n - 1, each once."""
    out = df.agg(F.count(index).alias("n"), F.min(index).alias("least"), F.max(index).alias("greatest"), F.countDistinct(index).alias("__d"))
    return out.withColumn("contiguous", (F.col("least") == 0) & (F.col("greatest") == F.col("n") - 1) & (F.col("__d") == F.col("n"))).drop("__d")


def totals(episodes: DataFrame, tasks: DataFrame, cameras: int = 0, chunk_size: int = 1000) -> DataFrame:
    """One row of the dataset's totals."""
    t = tasks.agg(F.count("*").alias("total_tasks")).first()[0]
    e = episodes.agg(F.count("*").alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames"))
    return e.withColumns({"total_tasks": F.lit(t).cast("long"), "total_videos": F.col("total_episodes") * cameras, "total_chunks": F.ceil(F.col("total_episodes") / chunk_size)})


def noop_rollup(flags: DataFrame, episode: str, flag: str) -> DataFrame:
    """One row: episodes, frames, candidates, share, episodes that are all no-ops."""
    per = flags.groupBy(episode).agg(F.count("*").alias("f"), F.sum(F.col(flag).cast("long")).alias("c"))
    return per.agg(F.count("*").alias("episodes"), F.sum("f").alias("frames"), F.sum("c").alias("candidates"), F.try_divide(F.sum("c"), F.sum("f")).alias("share"), F.sum((F.col("f") == F.col("c")).cast("long")).alias("all_noop"))


def error_summary(df: DataFrame, keys: list[str], error: str) -> DataFrame:
    """keys, mean, p95, worst."""
    return df.groupBy(*keys).agg(F.avg(error).alias("mean"), F.percentile(error, 0.95).alias("p95"), F.max(error).alias("worst"))


def best_candidate(df: DataFrame, keys: list[str], candidate: str, score: str) -> DataFrame:
    """keys and the candidate with the least score (of equals, the least candidate)."""
    return df.groupBy(*keys).agg(F.min(F.struct(score, candidate)).alias("__b")).select(*keys, F.col(f"__b.{candidate}").alias(candidate), F.col(f"__b.{score}").alias(score))


def linear_fit(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """keys, slope, intercept, r2 of y on x."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def linear_fit3(df: DataFrame, keys: list[str], x: str, y: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """keys, coefficients, r2: least squares of y on a vector of 3 through the origin, of rows with y in the quantiles.

    Sums of products by group (normal equations, solved by Cramer's rule): one aggregation.
    """
    if (low, high) != (0.0, 1.0):
        edges = df.groupBy(*keys).agg(F.percentile(y, [low, high]).alias("__q"))
        df = df.join(edges, keys).where(F.col(y).between(F.col("__q")[0], F.col("__q")[1]))
    v = [F.get(F.col(x), F.lit(i)) for i in range(3)]
    m = [[F.sum(a * b) for b in v] for a in v]
    r = [F.sum(a * F.col(y)) for a in v]
    det = lambda c: c[0][0] * (c[1][1] * c[2][2] - c[1][2] * c[2][1]) - c[0][1] * (c[1][0] * c[2][2] - c[1][2] * c[2][0]) + c[0][2] * (c[1][0] * c[2][1] - c[1][1] * c[2][0])
    s = df.groupBy(*keys).agg(F.array(*[e for row in m for e in row]).alias("m"), F.array(*r).alias("r"), F.sum(F.col(y) * F.col(y)).alias("yy"))
    at = [[F.get("m", F.lit(3 * i + j)) for j in range(3)] for i in range(3)]
    rhs = [F.get("r", F.lit(i)) for i in range(3)]
    solved = [F.try_divide(det([[rhs[i] if j == k else at[i][j] for j in range(3)] for i in range(3)]), det(at)) for k in range(3)]
    out = s.withColumn("coefficients", F.array(*solved))
    explained = sum((F.get("coefficients", F.lit(i)) * rhs[i] for i in range(1, 3)), F.get("coefficients", F.lit(0)) * rhs[0])
    return out.select(*keys, "coefficients", F.try_divide(explained, F.col("yy")).alias("r2"))
