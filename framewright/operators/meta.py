"""Joining episodes with metadata, ledgers and dictionaries; set checks; snapshots; samples and shards.

Small dimensions are left to the planner, which broadcasts what is under its size threshold and sorts what isn't.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .trajectory import global_rank


def left_lookup(df: DataFrame, dim: DataFrame, on: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """df with the dimension's columns; defaults where it has no row."""
    seen = dim.withColumn("__hit", F.lit(True))
    out = df.join(seen, on, "left")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.when(F.col("__hit"), F.col(name)).otherwise(F.lit(value)))
    return out.drop("__hit")


def strict_lookup(df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """An inner join that fails at run time if a row of df has no partner."""
    out = df.join(dim.withColumn("__hit", F.lit(True)), on, "left")
    return out.where(F.when(F.col("__hit"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no metadata for "), *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in on])).cast("boolean"))).drop("__hit")


def subset(df: DataFrame, mask: DataFrame, on: list[str]) -> DataFrame:
    return df.join(mask, on, "left_semi")


def pending(wanted: DataFrame, ledger: DataFrame, on: list[str], done: Column) -> DataFrame:
    """Rows of wanted without a ledger row for which ``done`` (over both) holds."""
    w, l = wanted.alias("w"), ledger.alias("l")
    match = done
    for c in on:
        match = match & (F.col(f"w.{c}") == F.col(f"l.{c}"))
    return w.join(l, match, "left_anti")


def orphans(files: DataFrame, referenced: DataFrame, on: list[str]) -> DataFrame:
    return files.join(referenced, on, "left_anti")


def keyed_merge(tables: list[DataFrame], key: str) -> DataFrame:
    """All tables side by side by key; fails at run time where a key lacks in one of them."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn(f"__has{i}", F.lit(True))
        out = t if out is None else out.join(t, key, "full")
    whole = F.lit(True)
    for i in range(len(tables)):
        whole = whole & F.col(f"__has{i}").isNotNull()
    checked = out.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{key} lacks a part: "), F.col(key).cast("string"))).cast("boolean")))
    return checked.drop(*[f"__has{i}" for i in range(len(tables))])


def task_dictionary(df: DataFrame, task: str, order: list[str]) -> DataFrame:
    """task, task_index: dense numbers by first appearance, by ranges of it."""
    first = df.groupBy(task).agg(F.min(F.struct(*order)).alias("__o"))
    return global_rank(first, ["__o", task], "task_index").select(task, F.col("task_index").cast("long"))


def with_task_index(df: DataFrame, tasks: DataFrame, task: str) -> DataFrame:
    return df.join(tasks.select(task, "task_index"), task)


def in_ranges(rows: DataFrame, spans: DataFrame, at: str, low: str, high: str, width: int) -> DataFrame:
    """rows with the span that has low <= at < high, by an equal join on bins of ``width`` (exact at any width)."""
    binned = spans.where(F.col(high) > F.col(low)).withColumn("__bin", F.explode(F.sequence(F.expr(f"{low} div {width}"), F.expr(f"({high} - 1) div {width}"))))
    r = rows.withColumn("__bin", F.expr(f"{at} div {width}"))
    return r.join(binned, (r["__bin"] == binned["__bin"]) & (r[at] >= binned[low]) & (r[at] < binned[high])).drop("__bin")


def wanted_with_presence(wanted: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """wanted and ``present``."""
    return wanted.join(present.select(*on).distinct().withColumn("present", F.lit(True)), on, "left").withColumn("present", F.coalesce("present", F.lit(False)))


def broadcast_label(frames: DataFrame, episodes: DataFrame, episode: str, label: str) -> DataFrame:
    """frames with their episode's label; NULL where it has none."""
    return frames.join(episodes.select(episode, label), episode, "left")


def min_length(df: DataFrame, episode: str, n: int) -> DataFrame:
    """Episodes of n frames or more."""
    return df.join(df.groupBy(episode).agg(F.count("*").alias("__n")).where(F.col("__n") >= n), episode, "left_semi")


def keep_episodes(episodes: DataFrame, length: Column, dataset: Column, success: Column, only_successes_of: list[str]) -> DataFrame:
    """Episodes with frames; of some datasets, those that succeeded only (an unknown outcome isn't one)."""
    return episodes.where((length > 0) & (~F.coalesce(dataset.isin(only_successes_of), F.lit(False)) | F.coalesce(success, F.lit(False))))


def with_all_present(episodes: DataFrame, present: DataFrame, episode: str, key: str, wanted: list[str]) -> DataFrame:
    """Episodes that have every wanted key (a camera's video, say) in ``present``; with none wanted, all."""
    if not wanted:
        return episodes
    has = present.where(F.col(key).isin(wanted)).groupBy(episode).agg(F.countDistinct(key).alias("__n")).where(F.col("__n") == len(set(wanted)))
    return episodes.join(has, episode, "left_semi")


def matching(df: DataFrame, equal: dict[str, str | None], containing: dict[str, str | None]) -> DataFrame:
    """Rows whose columns equal (or contain) the values asked for, whatever the case; None asks for nothing."""
    for c, v in equal.items():
        df = df if v is None else df.where(F.lower(c) == v.lower())
    for c, v in containing.items():
        df = df if v is None else df.where(F.contains(F.lower(c), F.lit(v.lower())))
    return df


def drop_by_threshold(df: DataFrame, episode: str, value: Column, most: float) -> DataFrame:
    """Episodes whose largest value isn't above ``most``."""
    bad = df.groupBy(episode).agg(F.max(value).alias("__m")).where(F.col("__m") > most)
    return df.join(bad, episode, "left_anti")


def snapshot_diff(old: DataFrame, new: DataFrame, run: str, rollout: str, user: str) -> DataFrame:
    """One row: new_runs, new_rollouts, new_users (a count and the sorted names)."""
    runs = new.select(run).distinct().join(old.select(run), run, "left_anti").agg(F.count("*").alias("new_runs"))
    rolls = new.select(rollout).distinct().join(old.select(rollout), rollout, "left_anti").agg(F.count("*").alias("new_rollouts"))
    users = new.select(user).distinct().join(old.select(user), user, "left_anti").agg(F.count("*").alias("new_users"), F.sort_array(F.collect_set(user)).alias("users"))
    one = lambda d: d.withColumn("__k", F.lit(1))
    return one(runs).join(one(rolls), "__k").join(one(users), "__k").drop("__k")


def set_differences(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """side ('left', 'right') and the keys that only it has."""
    a, b = left.select(*on).distinct(), right.select(*on).distinct()
    return a.join(b, on, "left_anti").select(F.lit("left").alias("side"), *on).unionByName(b.join(a, on, "left_anti").select(F.lit("right").alias("side"), *on))


def coverage_gate(expected: DataFrame, actual: DataFrame, on: list[str]) -> DataFrame:
    """One row: expected, found, missing, extra, complete."""
    e, a = expected.select(*on).distinct().withColumn("__e", F.lit(1)), actual.select(*on).distinct().withColumn("__a", F.lit(1))
    j = e.join(a, on, "full")
    c = j.agg(F.count("__e").alias("expected"), F.sum((F.col("__e").isNotNull() & F.col("__a").isNotNull()).cast("long")).alias("found"), F.sum(F.col("__a").isNull().cast("long")).alias("missing"), F.sum(F.col("__e").isNull().cast("long")).alias("extra"))
    return c.withColumn("complete", (F.col("missing") == 0) & (F.col("extra") == 0))


def array_split_shard(ordinal: Column, total: int, shards: int) -> Column:
    """Shard of an ordinal: sizes differ by one at most, larger ones first."""
    size, extra = divmod(total, shards)
    cut = extra * (size + 1)
    return F.when(ordinal < cut, F.floor(ordinal / (size + 1))).otherwise(extra + F.floor((ordinal - cut) / F.lit(max(size, 1))))


def linspace_shard(ordinal: Column, total: int, shards: int) -> Column:
    """Shard by bounds floor(k total / shards)."""
    return F.floor(((ordinal + 1) * shards - 1) / F.lit(max(total, 1)))


def percent_slice(ordinal: Column, total: int, low: int, high: int) -> Column:
    """Whether an ordinal is in [low %, high %)."""
    bound = lambda p: (p * total + 50) // 100
    return (ordinal >= bound(low)) & (ordinal < bound(high))


def in_split(ordinal: Column, total: int, split: str) -> Column:
    """Whether an ordinal is in a split's slice: ``train``, ``train[2:8]``, ``train[:-5]``, ``train[10%:25%]``, ``train[50%:]``.

    Bounds are as in Python, or percents to the nearest whole episode; several slices may be joined by ``+``.
    """
    out = F.lit(False)
    for part in split.split("+"):
        m = re.fullmatch(r"\s*(\w+)(?:\[(-?\d+%?)?:(-?\d+%?)?\])?\s*", part)
        if not m:
            raise ValueError(f"no split: {part!r}")
        low, high = (_bound(b, total) for b in (m[2] or "0", m[3] or "100%"))
        out = out | ((ordinal >= low) & (ordinal < high))
    return out


def _bound(text: str, total: int) -> int:
    if text.endswith("%"):
        percent = int(text[:-1])
        if abs(percent) > 100:
            raise ValueError(f"{text} is beyond the whole")
        at = (abs(percent) * total + 50) // 100
        return total - at if percent < 0 else at
    return max(0, total + int(text)) if text.startswith("-") else min(int(text), total)


def strided_sample(ordinal: Column, total: int, k: int) -> Column:
    """Every (total // k)-th, k at most."""
    step = max(1, total // k)
    return (F.pmod(ordinal, F.lit(step)) == 0) & (F.floor(ordinal / step) < k)


def even_indices(total: int, k: int) -> Column:
    """An array: k places from the first to the last, halves to even, each once."""
    if total <= 0 or k <= 0:
        return F.array().cast("array<long>")
    step = (total - 1) / (k - 1) if k > 1 else 0.0
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * F.lit(step)).cast("long")))


def union_shards(shards: list[DataFrame], episode: str = "episode_index") -> DataFrame:
    """All shards under one another, episodes numbered on; schemas must be equal."""
    if len({tuple(sorted(s.dtypes)) for s in shards}) > 1:
        raise ValueError("shards differ in schema")
    out, sizes = None, []
    for i, s in enumerate(shards):
        t = s.withColumn("__shard", F.lit(i))
        out = t if out is None else out.unionByName(t)
    sizes = out.groupBy("__shard").agg((F.max(episode) + 1).alias("__n"))
    # As many rows as there are shards in the list.
    before = sizes.select("__shard", (F.sum("__n").over(W.orderBy("__shard")) - F.col("__n")).alias("__off"))
    return out.join(F.broadcast(before), "__shard").withColumn(episode, F.col(episode) + F.col("__off")).drop("__shard", "__off")
